"""Language identification: known words first, then ever shorter character n-grams.

A word in the model scores by its log frequency in each language.  A word the
model lacks falls back to its character n-grams, longest first: the first
length with a known n-gram decides, by the mean log frequency of those known.
A text's score is the sum over its words.

Words are runs of letters (ASCII letters, lower-cased, and all non-ASCII
signs).  The model is fitted on about TRAIN_ROWS labelled rows at most, taken
by a hash of the id and text, and holds at most MODEL_CELLS numbers.  Null
texts and texts without a letter are ``und`` with score 0; so is everything if
there is no labelled row.  A text of letters that no word and no n-gram of the
model knows gets the commonest language.  Equal scores go to the first
language by name.  Repeated rows are learned from and reported one by one; a
text of any length is one row, whose words are all counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.bytekernel import U, HashIndex, gather, slices, span_hashes, text_bytes, word_spans
from docloom.llm.common import crc_mod, lean, sampled, saved

TRAIN_ROWS = 20_000
MODEL_CELLS = 4_000_000
GRAMS = (5, 4, 3, 2, 1)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[128:] = False


def _word_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes joined, each between marks 1 and 2, and their offsets."""
    n = ends - starts
    off = np.concatenate([[0], np.cumsum(n + 2)])
    out = np.ones(off[-1], np.uint8)
    out[off[1:] - 1] = 2
    inner = np.ones(off[-1], bool)
    inner[off[:-1]] = inner[off[1:] - 1] = False
    out[inner] = gather(raw, starts, n)
    return out, off


def _grams(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word) of every n-gram of characters."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    word = np.searchsorted(off, at, "right") - 1
    end = np.append(at[1:], len(data))
    if len(at) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    one = word[: len(at) - n + 1] == word[n - 1 :]
    s, e = at[: len(at) - n + 1][one], end[n - 1 :][one]
    return span_hashes(data, s, e) ^ U(n), word[: len(at) - n + 1][one]


def _counts(train: DataFrame) -> DataFrame:
    """(lang, kind, h, c): counts of words (kind 0) and n-grams (kind n), summed in each batch first."""

    def go(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for i, j in slices(batch.column(1)):
                raw, off = text_bytes(batch.column(1).slice(i, j - i))
                s, e, first = word_spans(raw, off, _LETTER)
                h = span_hashes(raw, s, e)
                row_lang = np.repeat(langs[i:j], np.diff(first))
                for lang in np.unique(row_lang):
                    own = np.flatnonzero(row_lang == lang)
                    word, where, count = np.unique(h[own], return_index=True, return_counts=True)
                    data, woff = _word_bytes(raw, s[own[where]], e[own[where]])
                    found = [(0, word, count)]
                    for n in GRAMS:
                        g, w = _grams(data, woff, n)
                        name, back = np.unique(g, return_inverse=True)
                        found.append((n, name, np.bincount(back, count[w], minlength=len(name))))
                    for kind, name, c in found:
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(name), pa.string()), pa.array(np.full(len(name), kind, np.int32)), pa.array(name.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "kind", "h", "c"])

    return train.mapInArrow(lean(go), "lang string, kind int, h long, c long").groupBy("lang", "kind", "h").agg(F.sum("c").alias("c"))


class Model:
    """Log frequencies by language of words and n-grams."""

    def __init__(self, langs: list[str], prior: np.ndarray, tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.prior, self.tables = langs, prior, tables

    @staticmethod
    def fit(train: DataFrame) -> Model:
        """train: lang, text; already bounded."""
        have = dict(train.groupBy("lang").count().collect())
        langs = sorted(have)
        if not langs:
            return Model([], np.zeros(0), {})
        prior = np.array([have[x] for x in langs], np.float64)
        keys = MODEL_CELLS // len(langs)
        counts = _counts(train)
        by = [F.sum(F.when(F.col("lang") == x, F.col("c")).otherwise(0)).cast("double").alias(f"l{i}") for i, x in enumerate(langs)]
        wide = saved(counts.groupBy("kind", "h").agg(F.sum("c").alias("total"), *by).where("total > 1"), "ngrams")
        limit = {0: keys // 2} | {n: keys // 10 for n in GRAMS}
        tables = {}
        for kind, most in limit.items():
            # the model's own size limit, the commonest entries
            top = wide.where(F.col("kind") == kind).orderBy(F.desc("total"), "h").limit(most)
            got = top.drop("kind", "total").toPandas()
            c = got.iloc[:, 1:].to_numpy(np.float64) + 0.5
            tables[kind] = got["h"].to_numpy(np.int64).view(U), np.log(c / c.sum(0, keepdims=True)).astype(np.float32) if len(c) else np.zeros((0, len(langs)), np.float32)
        return Model(langs, prior / prior.sum(), tables)

    def open(self) -> Model:
        self.index = {k: HashIndex(h) for k, (h, _) in self.tables.items()}
        # a row of zeros for what is unknown, at -1
        self.rows = {k: np.concatenate([w, np.zeros((1, len(self.langs)), np.float32)]) for k, (_, w) in self.tables.items()}
        return self

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language of each row, -1 for und; its share of the scores)."""
        raw, off = text_bytes(column)
        n_rows, n_langs = len(off) - 1, len(self.langs)
        s, e, first = word_spans(raw, off, _LETTER)
        h = span_hashes(raw, s, e)
        place = self.index[0].find(h)
        total = np.zeros((n_rows, n_langs))
        row = np.repeat(np.arange(n_rows), np.diff(first))
        miss = np.flatnonzero(place < 0)
        new, where, back = np.unique(h[miss], return_index=True, return_inverse=True)
        extra = np.zeros((len(new), n_langs))
        if len(new):
            todo = np.arange(len(new))
            for n in GRAMS:
                at = miss[where[todo]]
                data, woff = _word_bytes(raw, s[at], e[at])
                g, w = _grams(data, woff, n)
                got = self.index[n].find(g)
                g, w = got[got >= 0], w[got >= 0]
                known = np.bincount(w, minlength=len(todo))
                for k in range(n_langs):
                    extra[todo, k] += np.bincount(w, self.rows[n][g, k], minlength=len(todo)) / np.maximum(known, 1)
                todo = todo[known == 0]
                if not len(todo):
                    break
        for k in range(n_langs):
            each = self.rows[0][place, k].astype(np.float64)
            if len(new):
                each[miss] = extra[back, k]
            total[:, k] = np.bincount(row, each, minlength=n_rows)
        words = np.diff(first)
        z = total / np.sqrt(np.maximum(words, 1))[:, None] + np.log(self.prior)
        best = z.argmax(1)
        p = np.exp(z - z.max(1, keepdims=True))
        share = p.max(1) / p.sum(1)
        letters = np.add.reduceat(np.append(_ASCII_LETTER[raw], False), np.minimum(off[:-1], len(raw))) > 0 if len(raw) else np.zeros(n_rows, bool)
        letters &= np.diff(off) > 0
        for r in np.flatnonzero(~letters & (words > 0)).tolist():
            letters[r] = any(c.isalpha() for c in column[r].as_py())
        return np.where(letters, best, -1), np.where(letters, share, 0.0)


def fit(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """A model from at most about rows labelled rows outside held_out; which ones depends on a hash of their ids and texts alone."""
    labelled = docs.where(~held_out & F.col(lang).isNotNull()).select(F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return Model.fit(sampled(labelled, rows, "i", "text", seed=8).select("lang", "text"))


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or the columns to keep of it) with lang_pred and score."""
    names = np.array([*model.langs, "und"], object)
    docs = docs.withColumn("__text", F.col(text).cast("string"))
    kept = (docs.select(*keep) if keep is not None else docs).drop("lang_pred", "score", "__text")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", lang_pred string, score double"

    def go(batches):
        opened = model.open() if model.langs else None
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            rest = batch.select(list(range(batch.num_columns - 1)))
            for i, j in slices(column):
                best, share = opened.score(column.slice(i, j - i)) if opened else (np.full(j - i, -1), np.zeros(j - i))
                yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, pa.array(names[best], pa.string()), pa.array(share)], [*rest.schema.names, "lang_pred", "score"])

    return docs.select(*kept.columns, "__text").mapInArrow(lean(go), schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score.  The model learns from rows whose crc32(id) mod 4 is not 2."""
    held = F.coalesce(crc_mod(F.col(doc_id), 4) == 2, F.lit(False))
    model = fit(docs, held, doc_id, text, lang)
    base = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("__body"))
    return predict(base, model, "__body", ["doc_id", "held_out"])
