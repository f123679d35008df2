"""Quality scores by a generalised additive model with pairwise interactions.

Every text becomes a row of shape statistics.  Each statistic is cut into
quantile bins; boosting goes round the features in turn, fitting a shallow
tree on one feature's bins at a small rate, so each feature ends as a lookup
table.  The pairs whose joint bins still explain most of the residual then get
two-dimensional tables in the same way.  A score is the logistic of the sum of
table entries, added bin by bin in numpy.

The model learns from about TRAIN_ROWS labelled rows at most, taken by a hash
of the id; every text is scored whole.  Null and empty texts have all
statistics 0 and are scored like any other.  Without labelled rows every score
is 0.5.  Repeated rows are scored one by one and alike; a label that stands
twice, or a labelled text that does, is learned from as often.  Equal gains go
to the first cut and the pair of later features, so a fit is repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.bytekernel import NON_SPACE, U, slices, span_hashes, text_bytes, word_spans
from docloom.llm.common import crc_mod, sampled

TRAIN_ROWS = 20_000
#: Sampled labels are broadcast up to this many (16 bytes each).
SENT = 200_000
BINS = 32
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 250
PAIR_ROUNDS = 80
RATE = 0.08

_UPPER, _LOWERC, _DIGIT, _PUNCT, _RARE, _STOP, _EXCL = (np.zeros(256, bool) for _ in range(7))
_UPPER[65:91] = True
_LOWERC[97:123] = True
_DIGIT[48:58] = True
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_RARE[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_STOP[[ord(c) for c in ".!?"]] = True
_EXCL[ord("!")] = True
_NOT_NL = np.ones(256, bool)
_NOT_NL[10] = False

FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "punctuation", "rare_signs", "distinct_words", "top_word", "same_as_before", "exclaims",
    "repeated_lines", "words_a_line", "short_words", "non_ascii", "pipes", "sentence_ends", "odd_word_ends", "distinct_a_root",
)


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[off[1:]] - total[off[:-1]]).astype(np.float64)


def _repeats(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, count of the commonest) of each row."""
    if not len(h):
        return np.zeros(n_rows), np.zeros(n_rows)
    key = np.sort((row.astype(U) << U(44)) | (h >> U(20)))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    owner = (key[at] >> U(44)).astype(np.int64)
    most = np.zeros(n_rows)
    np.maximum.at(most, owner, np.diff(np.append(at, len(key))))
    return np.bincount(owner, minlength=n_rows).astype(np.float64), most


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    raw, off = text_bytes(column)
    n = len(off) - 1
    s, e, first = word_spans(raw, off, NON_SPACE)
    h = span_hashes(raw, s, e)
    words = np.diff(first).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(first))
    w = np.maximum(words, 1)
    size = np.maximum(_per_row(NON_SPACE[raw], off), 1)
    upper = _per_row(_UPPER[raw], off)
    letters = np.maximum(upper + _per_row(_LOWERC[raw], off), 1)
    distinct, most = _repeats(row, h, n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    ls, le, lfirst = word_spans(raw, off, _NOT_NL)
    lines = np.diff(lfirst).astype(np.float64)
    dl, _ = _repeats(np.repeat(np.arange(n), np.diff(lfirst)), span_hashes(raw, ls, le), n)
    at_row = lambda flags: np.bincount(row, flags, minlength=n)
    tail = raw[e - 1] if len(e) else raw[:0]
    out = [
        np.log1p(words), size / w * (words > 0), upper / letters, _per_row(_DIGIT[raw], off) / size, _per_row(_PUNCT[raw], off) / size, _per_row(_RARE[raw], off) / size, distinct / w, most / w,
        at_row(same) / w, _per_row(_EXCL[raw], off) / w, 1 - dl / np.maximum(lines, 1) * (lines > 0) - (lines == 0), words / np.maximum(lines, 1), at_row(e - s <= 3) / w, _per_row(raw >= 128, off) / size,
        _per_row(raw == 124, off) / w, _per_row(_STOP[raw], off) / w, at_row(_RARE[tail] | _EXCL[tail]) / w, distinct / np.sqrt(w),
    ]
    return np.stack(out, 1)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values per bin of a greedy tree of a few leaves over ordered bins."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], (a, b), int(k[i]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _tree2(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of a tree that cuts the first feature once and the second once on either side, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    n, m = g.shape
    best, cut = -1.0, None
    total = cg[-1, -1] ** 2 / (ch[-1, -1] + 1.0)
    for i in range(n - 1):
        gain, cuts = 0.0, []
        for tg, th in ((cg[i], ch[i]), (cg[-1] - cg[i], ch[-1] - ch[i])):
            each = tg[:-1] ** 2 / (th[:-1] + 1.0) + (tg[-1] - tg[:-1]) ** 2 / (th[-1] - th[:-1] + 1.0)
            k = int(each.argmax())
            gain += each[k]
            cuts.append(k)
        if gain > best:
            best, cut = gain, (i, *cuts)
    out = np.zeros((n, m))
    i, *cuts = cut
    for rows, k in ((slice(0, i + 1), cuts[0]), (slice(i + 1, n), cuts[1])):
        for cols in (slice(0, k + 1), slice(k + 1, m)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return out, best - total


@dataclass
class Additive:
    """Lookup tables per feature and per pair of features."""

    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        if not len(y) or not 0 < y.mean() < 1:
            self.base = 0.0 if not len(y) else (6.0 if y.mean() == 1 else -6.0)
            return self
        cuts = lambda v, k: np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1]))
        self.edges = [cuts(v, BINS) for v in x.T]
        self.coarse = [cuts(v, PAIR_BINS) for v in x.T]
        fine = [np.searchsorted(c, v, "right") for c, v in zip(self.edges, x.T, strict=True)]
        wide = [np.searchsorted(c, v, "right") for c, v in zip(self.coarse, x.T, strict=True)]
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        self.tables = [np.zeros(len(c) + 1) for c in self.edges]
        z = np.full(len(y), self.base)

        def slope():
            p = 1 / (1 + np.exp(-z))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for t, b in zip(self.tables, fine, strict=True):
                g, h = slope()
                step = RATE * _tree(np.bincount(b, g, minlength=len(t)), np.bincount(b, h, minlength=len(t)))
                t += step
                z += step[b]
        g, h = slope()
        flat = lambda i, j: wide[i] * (len(self.coarse[j]) + 1) + wide[j]
        shape = lambda i, j: (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
        grid = lambda v, i, j: np.bincount(flat(i, j), v, minlength=np.prod(shape(i, j))).reshape(shape(i, j))
        able = [i for i in range(x.shape[1]) if len(self.coarse[i])]
        gains = [(_tree2(grid(g, i, j), grid(h, i, j))[1], i, j) for k, i in enumerate(able) for j in able[k + 1 :]]
        self.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
        self.grids = [np.zeros(shape(i, j)) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for t, (i, j) in zip(self.grids, self.pairs, strict=True):
                g, h = slope()
                step = RATE * _tree2(grid(g, i, j), grid(h, i, j))[0]
                t += step
                z += step[wide[i], wide[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for i, (c, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(c, x[:, i], "right")]
        wide = {i: np.searchsorted(self.coarse[i], x[:, i], "right") for p in self.pairs for i in p}
        for (i, j), t in zip(self.pairs, self.grids, strict=True):
            z += t[wide[i], wide[j]]
        return 1 / (1 + np.exp(-z))


def train(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Additive:
    """Fits on at most about rows labelled rows outside held_out; which ones depends on a hash of their ids alone."""
    marked = labels.select(F.col(doc_id).alias("i"), F.col(label).cast("double").alias("y")).where("i is not null and y is not null").where(~held_out)
    marked = sampled(marked, rows, "i", seed=6)
    marked = F.broadcast(marked) if marked.count() <= SENT else marked

    def go(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                x = features(batch.column(1).slice(i, j - i))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["y", "x"])

    sample = docs.select(F.col(doc_id).alias("i"), F.col(text).cast("string").alias("t")).join(marked, "i").select("y", "t").mapInArrow(go, "y double, x array<double>")
    got = sample.toPandas()
    x, y = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES)), got["y"].to_numpy(np.float64)
    order = np.lexsort((*x.T[::-1], y))
    return Additive().fit(x[order], y[order])


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """Per document row: doc_id, held_out (crc32(id) mod 5 is 0; never learned from), score, predicted (score >= threshold)."""
    held = lambda c: F.coalesce(crc_mod(F.col(c), 5) == 0, F.lit(False))
    model = train(docs, labels, held("i"), doc_id, text, label)

    def go(batches):
        for batch in batches:
            for i, j in slices(batch.column(2)):
                score = model.score(features(batch.column(2).slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held(doc_id).alias("held_out"), F.col(text).cast("string").alias("t"))
    return base.mapInArrow(go, "doc_id long, held_out boolean, score double, predicted int")
