"""Benchmark decontamination with a distributed positional inverted index.

Index: documents are dealt into blocks of about a million words.  A block's
row holds its sorted terms (64-bit word hashes), the extent of each term's
postings, the postings themselves (positions, ascending, 32 bit) and the
bounds of its documents.  Positions of neighbouring documents are GAP apart,
so neither a phrase nor a proximity match can span two documents.  The index
is document-partitioned: building it needs no shuffle, and a hot term only
lengthens its list inside each block.

Search: a phrase is looked up from its rarest terms; lists are shifted by the
term's offset and intersected, rarest first, until one is empty or all terms
agree.

Test texts are cut into overlapping pieces of PIECE_WORDS words, and a search
takes pieces of up to TEST_BYTES at a time; with more than one such pass, each
pass's hits are written before the next is gathered, and a document's are put
together by its block's number and its place in the block.

Null and empty texts have no words; a document longer than a block gets a
block of its own.  Repeated rows, and blocks of the very same documents, are
indexed and reported one by one; repeated test rows are searched once.  Test
rows without an id are searched as all others: their words are hit and they
count as one more item, which only the id list and its digest leave out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.bytekernel import ALNUM, U, slices, span_hashes, text_bytes, word_spans
from docloom.llm.common import lean, saved

GAP = 64
BLOCK_WORDS = 1_000_000
#: Words of tests (8 bytes each) that travel with a pass; larger sets take several passes over the index.
TEST_BYTES = 16 << 20
PIECE_WORDS = 100_000

INDEX_SCHEMA = "block long, ids binary, id_nulls binary, first binary, terms binary, extent binary, postings binary"


def _index_block(block, ids, nulls, counts, hashes) -> dict:
    first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return {
        "block": block, "ids": ids.tobytes(), "id_nulls": nulls.tobytes(), "first": first.astype(np.uint32).tobytes(), "terms": h[new].tobytes(),
        "extent": np.append(new, len(h)).astype(np.uint32).tobytes(), "postings": (order + row[order] * GAP).astype(np.uint32).tobytes(),
    }


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per block of documents; schema INDEX_SCHEMA.  A block's number is its task's and its place in the task."""

    def build(batches):
        held, words, block = [], 0, TaskContext.get().partitionId() << 32

        def out():
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            return pa.RecordBatch.from_pylist([_index_block(block, *cols)], schema=schema)

        schema = pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in ("ids", "id_nulls", "first", "terms", "extent", "postings"))])
        for batch in batches:
            column = batch.column(1)
            nulls = np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).cast(pa.int64()).fill_null(0))
            for i, j in slices(column):
                raw, off = text_bytes(column.slice(i, j - i))
                s, e, first = word_spans(raw, off, ALNUM)
                if held and words + len(s) > block_words:
                    yield out()
                    held, words, block = [], 0, block + 1
                held.append((ids[i:j], nulls[i:j], np.diff(first), span_hashes(raw, s, e)))
                words += len(s)
        if held:
            yield out()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(lean(build), INDEX_SCHEMA)


class Block:
    """One block of the index, opened for search."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["id_nulls"], bool)
        self.first = np.frombuffer(row["first"], np.uint32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], U)
        self.extent = np.frombuffer(row["extent"], np.uint32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32)
        #: First position of each document.
        self.base = self.first[:-1] + np.arange(len(self.ids)) * GAP

    def locate(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each term, its list's length; 0 where absent)."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        found = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        return at, np.where(found, self.extent[at + 1] - self.extent[at] if len(self.terms) else 0, 0)

    def listed(self, place: int) -> np.ndarray:
        return self.postings[self.extent[place] : self.extent[place + 1]]

    def phrase(self, places: np.ndarray, df: np.ndarray) -> np.ndarray:
        """Start positions at which the terms stand consecutively."""
        found = None
        for k in np.argsort(df, kind="stable").tolist():
            have = self.listed(places[k])
            if found is None:
                found = have.astype(np.int64) - k
            else:
                want = found + k
                at = np.searchsorted(have, want)
                at[at == len(have)] = 0
                found = found[have[at] == want]
            if not len(found):
                break
        return found

    def near(self, places: np.ndarray, df: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the first term that have every other term within slop words (slop < GAP)."""
        assert 0 <= slop < GAP
        found = self.listed(places[0]).astype(np.int64)
        for k in np.argsort(df, kind="stable").tolist():
            if k:
                have = self.listed(places[k]).astype(np.int64)
                found = found[np.searchsorted(have, found + slop, "right") > np.searchsorted(have, found - slop)]
        return found

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        """The document of each position; an empty document shares no position with the next, so the last base at or below is right."""
        return np.searchsorted(self.base, positions, "right") - 1


def hash_terms(texts: list[str | None]) -> list[np.ndarray]:
    raw, off = text_bytes(pa.array(texts, pa.string()))
    s, e, first = word_spans(raw, off, ALNUM)
    h = span_hashes(raw, s, e)
    return [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def _search_block(block: Block, items: list[tuple[int | None, np.ndarray]], window: int):
    """(start, length, item) arrays of all occurrences of all item windows."""
    starts, lengths, which = [], [], []
    for n, (_, terms) in enumerate(items):
        width = min(window, len(terms))
        if not width:
            continue
        at, df = block.locate(terms)
        there = np.convolve(df > 0, np.ones(width, int), "valid") == width
        for i in np.flatnonzero(there).tolist():
            got = block.phrase(at[i : i + width], df[i : i + width])
            if len(got):
                starts.append(got)
                lengths.append(np.full(len(got), width))
                which.append(np.full(len(got), n))
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, z
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(which)


def _pieces(tests: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """(i, terms): the test texts as hashed words, in pieces that overlap by window - 1 words."""

    def cut(batches):
        for batch in batches:
            for i, terms in zip(batch.column(0).to_pylist(), hash_terms(batch.column(1).to_pylist()), strict=True):
                starts = range(0, max(1, len(terms) - window + 1), PIECE_WORDS)
                for a in starts if len(terms) else ():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([terms[a : a + PIECE_WORDS + window - 1].tobytes()], pa.binary())], ["i", "terms"])

    rows = tests.select(F.col(item_id).cast("long").alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    return rows.mapInArrow(lean(cut), "i long, terms binary").distinct()


def _passes(tests: DataFrame, window: int, item_id: str, text: str):
    """(number of passes, their items): the test set in parts of a bounded size, gathered one at a time."""
    pieces = saved(_pieces(tests, window, item_id, text), "tests")
    total = pieces.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    n = max(1, -(-2 * total // TEST_BYTES) if total > TEST_BYTES else 1)

    def gather():
        for k in range(n):
            rows = (pieces if n == 1 else pieces.where(F.pmod(F.xxhash64("i", "terms"), F.lit(n)) == k)).collect()
            yield [(r.i, np.frombuffer(r.terms, U)) for r in rows]

    return n, gather()


HITS = "block long, row long, doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<long>"


def phrase_hits(index: DataFrame, tests: DataFrame, window: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Per indexed document: its words, the merged word spans hit by any window of any test text, and the test ids with an occurrence (a null for those without an id)."""

    def searcher(items):
        names = np.array([i or 0 for i, _ in items], np.int64)
        named = np.array([i is not None for i, _ in items], bool)

        def search(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block(row)
                    start, length, item = _search_block(block, items, window)
                    doc = block.row_of(start)
                    start = start - block.base[doc] if len(doc) else start
                    order = np.lexsort((start, doc))
                    doc, start, length, item = doc[order], start[order], length[order], item[order]
                    cut = np.searchsorted(doc, np.arange(len(block.ids) + 1))
                    spans, found = [], []
                    for k in range(len(block.ids)):
                        a, b = cut[k], cut[k + 1]
                        if a == b:
                            spans.append([])
                            found.append([])
                            continue
                        end = np.maximum.accumulate(start[a:b] + length[a:b])
                        new = np.flatnonzero(np.concatenate([[True], start[a + 1 : b] > end[:-1]]))
                        spans.append([{"a": int(x), "b": int(y)} for x, y in zip(start[a:b][new], end[np.append(new[1:], b - a) - 1], strict=True)])
                        own = item[a:b]
                        known = named[own]
                        found.append(np.unique(names[own[known]]).tolist() + [None] * (not known.all()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(block.ids), row["block"])), pa.array(np.arange(len(block.ids))), pa.array(block.ids, mask=block.nulls), pa.array(np.diff(block.first)),
                            pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(found, pa.list_(pa.int64())),
                        ],
                        ["block", "row", "doc_id", "n_words", "spans", "items"],
                    )

        return search

    n, passes = _passes(tests, window, item_id, text)
    if n == 1:
        return index.mapInArrow(lean(searcher(next(passes))), HITS)
    whole = None
    for items in passes:  # a pass's words are let go once its hits are written
        part = saved(index.mapInArrow(lean(searcher(items)), HITS), "hits")
        whole = part if whole is None else whole.unionByName(part)
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= s["a"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], s["b"]).alias("b"))))).otherwise(F.concat(acc, F.array(s))),
    )
    return whole.groupBy("block", "row", "doc_id", "n_words").agg(merged.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def proximity_hits(index: DataFrame, terms: str, slop: int) -> DataFrame:
    """(doc_id, position): word positions of the first of the terms with all others within slop words on either side, one row each.

    Without terms there is none; a term given twice counts once.  Null ids are reported as such.
    """
    given = hash_terms([terms])[0]
    want = given[np.sort(np.unique(given, return_index=True)[1])]

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                at, df = block.locate(want)
                pos = block.near(at, df, slop) if len(want) and (df > 0).all() else np.zeros(0, np.int64)
                doc = block.row_of(pos)
                yield pa.RecordBatch.from_arrays([pa.array(block.ids[doc], mask=block.nulls[doc]), pa.array(pos - block.base[doc] if len(doc) else pos)], ["doc_id", "position"])

    return index.mapInArrow(search, "doc_id long, position long")


def contamination(docs: DataFrame, tests: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated (n_hit > 0), spans."""
    index = saved(build_index(docs, doc_id, text), "postings")
    hits = phrase_hits(index, tests, window, item_id, item_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_compact("items").alias("items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans",
    )
