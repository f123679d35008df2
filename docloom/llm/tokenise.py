"""Exact encoding with a public tokenizer file, each distinct word once.

The tokenizer lower-cases, splits into letter runs, single digits, runs of
other signs and contractions, and merges inside each piece alone.  So a text's
ids are its pieces' ids joined.  Texts of ASCII and Latin-1 letters without
contractions, control characters or special-token strings are cut on bytes;
pieces seen before come from a cache keyed by their 64-bit hash, new ones are
encoded by the same merge model.  All other texts go to the tokenizer whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docloom.llm.bytekernel import LOWER, U, VALUE_CASED, span_hashes, text_bytes

_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[48:58] = 2
_CONTROL = np.zeros(256, bool)
_CONTROL[:9] = _CONTROL[14:32] = _CONTROL[127] = True
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in "strvmldSTRVMLD"]] = True
#: Places of known pieces, 14 bytes each; one is overwritten by the next of its place.
_SLOTS = 1 << 21
_LONGEST = 200


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes Arrow text columns to uint16 ids (the vocabulary must have fewer than 65536)."""

    _by_path: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One encoder a worker process."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        assert self.size < 1 << 16
        self.piece = Tokenizer(self.whole.model)
        self.piece.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.size, bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(_SLOTS, U)
        self.at = np.zeros(_SLOTS, np.int32)
        self.len = np.zeros(_SLOTS, np.uint16)
        self.pool = np.zeros(1 << 21, np.uint16)
        self.used = 0

    def _add(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes the pieces into the pool: their places and lengths."""
        texts = [b"\n".join(pieces[i : i + 1000]).decode() for i in range(0, len(pieces), 1000)]
        ids = np.concatenate([np.array(x.ids, np.uint16) for x in self.piece.encode_batch_fast(texts, add_special_tokens=False)])
        stop = np.flatnonzero(self.ends[ids]) + 1
        assert len(stop) == len(pieces)
        start = np.concatenate([[0], stop[:-1]])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return start + self.used - len(ids), stop - start

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each row); null is empty."""
        raw, off = text_bytes(column)
        n_rows = len(off) - 1
        if not len(raw):
            return np.zeros(0, np.uint16), np.zeros(n_rows, np.int64)
        low = LOWER[raw]
        bad = _CONTROL[raw]
        lead = raw == 0xC3
        high = raw >= 0x80
        after = np.zeros(len(raw), bool)
        after[1:] = lead[:-1]
        bad |= high & ~lead & ~after
        bad |= after & ((raw == 0x97) | (raw == 0xB7))
        up = after & (raw <= 0x9E)
        low[up] += 0x20
        bad[:-1] |= (raw[:-1] == 39) & _TAIL[raw[1:]] | (raw[:-1] == 60) & (raw[1:] == 124)
        kind = _KIND[low]
        cut = off[(off > 0) & (off < len(raw))]
        begin = np.ones(len(raw), bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begin[cut] = True
        edge = np.flatnonzero(begin)
        stop = np.append(edge[1:], len(raw))
        word = kind[edge] != 0
        s, e = edge[word], stop[word]
        bad[s[e - s > _LONGEST]] = True
        odd = np.zeros(n_rows, bool)
        odd[np.searchsorted(off, np.flatnonzero(bad), "right") - 1] = True
        first = np.searchsorted(s, off)
        if odd.any():
            keep = ~np.repeat(odd, np.diff(first))
            s, e = s[keep], e[keep]
            first = np.searchsorted(s, off)
        h = span_hashes(low, s, e, VALUE_CASED)
        if self.used > 1 << 23:
            self.clear()
        slot = (h & U(_SLOTS - 1)).astype(np.int64)
        at, count = self.at[slot].astype(np.int64), self.len[slot].astype(np.int64)
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            new, where, back = np.unique(h[miss], return_index=True, return_inverse=True)
            buf = low.tobytes()
            place, size = self._add([buf[a:b] for a, b in zip(s[miss[where]].tolist(), e[miss[where]].tolist(), strict=True)])
            at[miss], count[miss] = place[back], size[back]
            slot = (new & U(_SLOTS - 1)).astype(np.int64)
            self.key[slot], self.at[slot], self.len[slot] = new, place, size
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(at - total[:-1], count) + np.arange(total[-1])]
        per_row = np.diff(total[first])
        if odd.any():
            rows = np.flatnonzero(odd)
            got = [np.array(x.ids, np.uint16) for x in self.whole.encode_batch_fast(column.take(pa.array(rows)).to_pylist(), add_special_tokens=False)]
            pieces = np.split(ids, total[first][1:-1])
            for r, x in zip(rows.tolist(), got, strict=True):
                pieces[r] = x
                per_row[r] = len(x)
            ids = np.concatenate(pieces)
        return ids, per_row
