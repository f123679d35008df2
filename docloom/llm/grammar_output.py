"""Token-id output compressed by a Re-Pair grammar per shard.

A shard holds the ids of some documents in ascending doc_id order.  Each round
counts the adjacent pairs of its sequence and replaces frequent ones by new
nonterminals, until no pair is frequent enough or the 16-bit symbol space is
full.  The pairs of one round are chosen so that no
symbol is the left part of one and the right part of another; their
occurrences then never overlap, and a round replaces them all at once.  Pairs
never span two documents.  A shard stores its rules, each symbol's expansion
length and, per document, where its symbols and tokens begin; any document or
token range is decoded alone.

Null texts are empty, an empty document has the end id alone, repeated rows
are written each.  Null doc_ids come first.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.bytekernel import slices
from docloom.llm.common import lean, scratch_path
from docloom.llm.tokenise import WordEncoder, default_path

SHARD_TOKENS = 1_500_000
LEAST = 8
RULES_A_ROUND = 3000

SCHEMA = "part int, seq int, tokens long, ids binary, id_nulls binary, sym_start binary, tok_start binary, base int, rules binary, lengths binary, symbols binary"


def _choose(pairs: np.ndarray, counts: np.ndarray, most: int) -> list[int]:
    """The most frequent pairs without a symbol that is both a left and a right part."""
    side: dict[int, int] = {}
    chosen = []
    for k in pairs[np.argsort(counts, kind="stable")[::-1]].tolist():
        a, b = k >> 16, k & 0xFFFF
        if a == b:
            if a in side:
                continue
            side[a] = 3
        elif side.get(a, 1) != 1 or side.get(b, 2) != 2:
            continue
        else:
            side[a], side[b] = 1, 2
        chosen.append(k)
        if len(chosen) == most:
            break
    return chosen


def compress(ids: np.ndarray, starts: np.ndarray, base: int, rounds: int | None = None, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, start of each document in them, rules as pairs) of concatenated documents of at least one id each; no limit of rounds by default."""
    s = ids.astype(np.uint32)
    last = np.zeros(len(s), bool)
    last[starts[1:] - 1] = True
    rules: list[int] = []
    for _ in itertools.count() if rounds is None else range(rounds):
        room = min(RULES_A_ROUND, (1 << 16) - base - len(rules))
        if room <= 0 or len(s) < 2:
            break
        key = (s[:-1] << np.uint32(16)) | s[1:]
        ordered = np.sort(key[~last[:-1]])
        if not len(ordered):
            break
        at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        count = np.diff(np.append(at, len(ordered)))
        often = count >= least
        pairs, count = ordered[at[often]], count[often]
        if len(pairs) > 4 * room:
            top = np.argpartition(count, len(count) - 4 * room)[-4 * room :]
            pairs, count = pairs[top], count[top]
        chosen = _choose(pairs, count, room)
        if not chosen:
            break
        want = np.array(chosen, np.uint32)
        order = np.argsort(want)
        left, right = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
        left[want >> 16] = True
        right[want & 0xFFFF] = True
        may = np.flatnonzero(left[s[:-1]] & right[s[1:]] & ~last[:-1])
        place = np.searchsorted(want[order], key[may])
        place[place == len(want)] = 0
        hit = want[order][place] == key[may]
        may, rule = may[hit], order[place[hit]]
        twin = s[may] == s[may + 1]
        if twin.any():  # in a run of one symbol every other occurrence
            i = may[twin]
            new = np.concatenate([[True], i[1:] != i[:-1] + 1])
            run = i[np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))]
            keep = np.ones(len(may), bool)
            keep[np.flatnonzero(twin)[(i - run) % 2 == 1]] = False
            may, rule = may[keep], rule[keep]
        s[may] = base + len(rules) + rule
        last[may] = last[may + 1]
        stay = np.ones(len(s), bool)
        stay[may + 1] = False
        s, last = s[stay], last[stay]
        rules += chosen
    return s.astype(np.uint16), np.concatenate([[0], np.flatnonzero(last) + 1]), np.array([(k >> 16, k & 0xFFFF) for k in rules], np.uint16).reshape(-1, 2)


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of each nonterminal."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.int64)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each of base + len(rules) symbols, where its terminals start in the pool, the pool)."""
    n = base + len(rules)
    length, start, pool = np.ones(n, np.int64), np.arange(n), [np.arange(base, dtype=np.uint16)]
    full: list[np.ndarray] = []
    used = base
    for i, (a, b) in enumerate(rules.tolist()):
        x = np.concatenate([full[c - base] if c >= base else np.array([c], np.uint16) for c in (a, b)])
        full.append(x)
        length[base + i], start[base + i] = len(x), used
        used += len(x)
    return length, start, np.concatenate(pool + full)


class Shard:
    """A stored shard, opened for decoding."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["id_nulls"], bool)
        self.sym_start = np.frombuffer(row["sym_start"], np.uint32).astype(np.int64)
        self.tok_start = np.frombuffer(row["tok_start"], np.uint32).astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], np.uint16)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        _, self.start, self.pool = expansions(np.frombuffer(row["rules"], np.uint16).reshape(-1, 2), row["base"])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self._len(symbols)
        total = np.cumsum(n)
        return self.pool[np.repeat(self.start[symbols] - total + n, n) + np.arange(total[-1] if len(n) else 0)]

    def _len(self, symbols: np.ndarray) -> np.ndarray:
        base = len(self.start) - len(self.lengths)
        out = np.ones(len(symbols), np.int64)
        up = symbols >= base
        out[up] = self.lengths[symbols[up].astype(np.int64) - base]
        return out

    def all(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        return self._expand(self.symbols[self.sym_start[k] : self.sym_start[k + 1]])

    def tokens(self, k: int, a: int, b: int) -> np.ndarray:
        """Tokens a to b of document k, expanding only the symbols that hold them."""
        s = self.symbols[self.sym_start[k] : self.sym_start[k + 1]]
        end = np.cumsum(self._len(s))
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(end, b, "left") + 1
        skip = end[i - 1] if i else 0
        return self._expand(s[i:j])[a - skip : b - skip]


def write_shards(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS, rounds: int | None = None) -> str:
    """Encodes every text, writes the shards in ascending doc_id order and returns their folder."""
    tokenizer = tokenizer or default_path()

    def encode(batches):
        coder, part = WordEncoder.of(tokenizer), TaskContext.get().partitionId()
        held, size, seq = [], 0, 0

        def out():
            ids, nulls, counts, tokens = [np.concatenate(x) for x in zip(*held, strict=True)]
            start = np.concatenate([[0], np.cumsum(counts)])
            symbols, sym_start, rules = compress(tokens, start, coder.size, rounds)
            length = rule_lengths(rules, coder.size)
            row = {
                "part": part, "seq": seq, "tokens": len(tokens), "ids": ids.tobytes(), "id_nulls": nulls.tobytes(), "sym_start": sym_start.astype(np.uint32).tobytes(), "tok_start": start.astype(np.uint32).tobytes(),
                "base": coder.size, "rules": rules.tobytes(), "lengths": length.astype(np.uint32).tobytes(), "symbols": symbols.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in SCHEMA.split(", ")])
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(0))
            nulls = np.asarray(batch.column(0).is_null())
            for i, j in slices(batch.column(1)):
                tokens, count = coder.encode(batch.column(1).slice(i, j - i))
                total = np.cumsum(count)
                if held and size + len(tokens) > shard_tokens:
                    yield out()
                    held, size, seq = [], 0, seq + 1
                held.append((ids[i:j], nulls[i:j], count + 1, np.insert(tokens, total, np.uint16(end_id))))
                size += len(tokens) + j - i
        if held:
            yield out()

    path = scratch_path(docs.sparkSession, "shards")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(lean(encode), SCHEMA).write.parquet(path)
    return path


def read_documents(spark, path: str) -> DataFrame:
    """Per stored document: doc_id, start (ids before it), n_tokens, ids_crc32; decoded from the files."""

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                data = memoryview(shard.all().astype("<u4")).cast("B")
                start = shard.tok_start
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), pa.array(shard.ids, mask=shard.nulls), pa.array(start[:-1]), pa.array(np.diff(start)), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # over one row a shard
    shards = stored.select("part", "seq", "tokens").withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).drop("tokens")
    out = stored.mapInArrow(lean(decode), "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return out.join(shards, ["part", "seq"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
