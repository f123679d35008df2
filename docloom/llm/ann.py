"""Inner-product search over randomly rotated one-bit codes.

A vector minus the mean is turned by a seeded random rotation and kept as one
sign bit a dimension, with two correction scalars: its length r and the inner
product f of its direction with the code's.  For a query q the code estimates
``<q, v> = <q, mean> + r * <q', code> / f`` without bias, and

    |error| <= |q'| * r * sqrt((1 - f * f) / f / f) * EPSILON / sqrt(dim - 1)

but for rare cases.  A vector is reranked, by the double-precision inner
product of the original vectors, only if its estimate plus that bound reaches
the k-th best score known.  Every valid row is indexed and scanned: there are
no buckets to miss and no caps.  The signs of some thousand codes at a time are
unpacked and multiplied at once, in single precision.

Queries are packed into blocks and the index's files dealt into groups.  A cell
of this grid is one row, with a block's vectors and a group's file names; its
task streams the files, carries the block's best scores through them, and
gives at most k rows a query.  There are as many groups as keep some cells for
every core, one where the blocks alone do.  Nothing but counts and file names
comes to the driver.

Vectors that are null, zero, of a length other than the commonest, or that
hold null or non-finite components take no part; nor do rows without an id.
Rows with the query's own id are not its candidates.  Of the rows of one query
id the smallest vector asks; as candidates, repeated rows are found each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import file_batches, saved

EPSILON = 3.0
#: Queries of a block.
QUERY_BLOCK = 2048
#: Cells of the grid for each core.
CELLS = 4
_STEP = 2048

INDEX_SCHEMA = "id long, code binary, r double, f double, v array<double>"


def _rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def valid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(id, v) rows that take part, and their dimension."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = top.d if top else 1
    return rows.where(F.size("v") == dim), dim


def build_index(rows: DataFrame, dim: int, seed: int = 7) -> DataFrame:
    """(id, code, r, f, v) of every row; the mean it was coded against is the frame's attribute in `centre`."""

    def sums(batches):
        total, n = np.zeros(dim), 0
        for batch in batches:
            total += _matrix(batch.column(0)).sum(0) if len(batch) else 0
            n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([n])], ["s", "n"])

    parts = rows.select("v").mapInArrow(sums, "s array<double>, n long")
    mean = parts.select(F.posexplode("s").alias("i", "x"), "n").groupBy("i").agg((F.sum("x") / F.greatest(F.sum("n"), F.lit(1))).alias("m")).orderBy("i").toPandas()["m"].to_numpy(np.float64)
    mean = mean if len(mean) == dim else np.zeros(dim)  # no rows
    turn = _rotation(dim, seed)

    def code(batches):
        for batch in batches:
            if not len(batch):
                continue
            u = (_matrix(batch.column(1)) - mean) @ turn
            r = np.sqrt((u * u).sum(1))
            f = np.abs(u).sum(1) / np.maximum(r, 1e-300) / np.sqrt(dim)
            bits = np.packbits(u > 0, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(r), pa.array(np.where(r > 0, f, 1.0)), batch.column(1)], ["id", "code", "r", "f", "v"])

    index = saved(rows.mapInArrow(code, INDEX_SCHEMA), "codes")
    index.centre, index.turn = mean, turn
    return index


def _best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    at = np.arange(len(row)) - np.searchsorted(row, row)
    return row[at < k], ids[at < k], score[at < k]


def _searcher(qid: np.ndarray, qv: np.ndarray, mean: np.ndarray, turn: np.ndarray, k: int, epsilon: float):
    dim = qv.shape[1]
    centred = qv @ turn
    shift = qv @ mean
    length = np.sqrt((qv * qv).sum(1))

    def search(batches):
        row, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        floor = np.full(len(qid), -np.inf)
        for batch in batches:
            for a in range(0, len(batch), _STEP):
                part = batch.slice(a, _STEP)
                vid, v = part.column(0).to_numpy(), _matrix(part.column(4))
                code, r, f = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(len(vid), -1), part.column(2).to_numpy(), part.column(3).to_numpy()
                sign = (np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
                slack = r * np.sqrt(np.maximum(1 - f * f, 0)) / f * epsilon / np.sqrt(max(dim - 1, 1))
                rows, found, scores = [row], [ids], [score]
                for b in range(0, len(qid), 512):
                    c = slice(b, b + 512)
                    guess = shift[c, None] + (centred[c].astype(np.float32) @ sign.T) * (r / f)
                    guess[qid[c, None] == vid[None, :]] = -np.inf
                    upper = guess + length[c, None] * slack * (1 + 1e-5) + 1e-6
                    upper[np.isinf(guess)] = -np.inf
                    if not np.isfinite(floor[c]).all():  # a first floor from the best estimates
                        n = min(k, guess.shape[1])
                        first = np.argpartition(guess, guess.shape[1] - n, axis=1)[:, -n:]
                        exact = np.einsum("qnd,qd->qn", v[first], qv[c])
                        exact[np.isinf(np.take_along_axis(guess, first, 1))] = -np.inf
                        if n == k:
                            floor[c] = np.maximum(floor[c], exact.min(1) - 1e-9 * np.abs(exact.min(1)))
                    near = (upper >= floor[c, None]) & (upper > -np.inf)
                    for x in np.flatnonzero(near.any(1)).tolist():  # a query's survivors at a time: only their vectors are fetched
                        y = np.flatnonzero(near[x])
                        exact = (v[y] * qv[b + x]).sum(1)
                        keep = exact >= floor[b + x]
                        rows.append(np.full(keep.sum(), b + x))
                        found.append(vid[y[keep]])
                        scores.append(exact[keep])
                row, ids, score = _best(np.concatenate(rows), np.concatenate(found), np.concatenate(scores), k)
                full = np.bincount(row, minlength=len(qid)) == k
                last = np.searchsorted(row, np.flatnonzero(full), "right") - 1
                floor[full] = np.maximum(floor[full], score[last])
        yield pa.RecordBatch.from_arrays([pa.array(qid[row]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    return search


def _packed(batches):
    """Queries (id, v) to blocks of at most QUERY_BLOCK: ids and vectors as bytes."""
    out = lambda t: pa.RecordBatch.from_arrays([pa.array([t.column(0).to_numpy().tobytes()], pa.binary()), pa.array([_matrix(t.column(1).combine_chunks()).tobytes()], pa.binary())], ["ids", "vectors"])
    held, size = [], 0
    for batch in batches:
        for a in range(0, len(batch), QUERY_BLOCK):
            held.append(batch.slice(a, QUERY_BLOCK))
            size += len(held[-1])
            while size >= QUERY_BLOCK:
                whole = pa.Table.from_batches(held)
                yield out(whole.slice(0, QUERY_BLOCK))
                held, size = whole.slice(QUERY_BLOCK).to_batches(), size - QUERY_BLOCK
    if size:
        yield out(pa.Table.from_batches(held))


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 7, epsilon: float = EPSILON) -> DataFrame:
    """The k nearest rows of each query row: query_id, rank, vec_id, score.

    queries is a condition on the column ``id``.  Nearness is the inner
    product in double precision; ties go to the smaller id.  Repeated ids are
    searched once, by their smallest vector, and found as often as they occur.
    """
    rows, dim = valid(vectors, vec_id, vector)
    spark = vectors.sparkSession
    index = build_index(rows, dim, seed)
    files = index.inputFiles()
    asked = index.where(queries).groupBy("id").agg(F.min("v").alias("v"))
    n = asked.count()
    blocks = saved(asked.repartition(max(1, -(-n // QUERY_BLOCK))).mapInArrow(_packed, "ids binary, vectors binary"), "queries")
    many = max(1, blocks.count())
    wanted = min(len(files), max(1, -(-CELLS * spark.sparkContext.defaultParallelism // many)))
    groups = spark.createDataFrame([(files[g::wanted],) for g in range(wanted)], "files array<string>")
    # the stated query set against all rows, in blocks: a row here is a block and a group of files
    cells = blocks.crossJoin(F.broadcast(groups)).repartition(many * wanted)
    mean, turn = index.centre, index.turn

    def search(batches):
        for batch in batches:
            for ids, v, files in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                qid = np.frombuffer(ids, np.int64)
                yield from _searcher(qid, np.frombuffer(v, np.float64).reshape(len(qid), dim), mean, turn, k, epsilon)(file_batches(files, INDEX_SCHEMA, _STEP))

    found = cells.select("ids", "vectors", "files").mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
