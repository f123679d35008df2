"""Chat formatting by token-level assembly.

Roles and texts are encoded apart, each alone, and joined by reserved ids that
no text can produce:

    TURN role SEP text END   TURN role SEP text END   ...

Control strings inside a role or a text are escaped, so the rendered text has
none but the template's: a backslash is doubled, and a backslash goes after
the first sign of a control string.  The loss mask covers the texts of the
assistant's turns, derived from the segments' lengths by a prefix sum over
+1 and -1 at their bounds.

Rows of a conversation stand by turn; equal turns by role, then by their
token ids.  Null texts and roles are empty, null turns come first, rows with a
null conversation id form one conversation, repeated rows are turns each.  A conversation of more than
PART_TOKENS is stored in several parts, cut between turns, and streamed.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import file_batches, scratch_path

PART_TOKENS = 1 << 16
#: Parts that are read at once.
READ_PARTS = 64
RESERVED = ("<|turn|>", "<|sep|>", "<|end|>")
CONTROL = (*RESERVED, "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>")
_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Template:
    """The tokenizer and the reserved ids above its vocabulary."""

    _by_path: dict[str, Template] = {}

    @classmethod
    def of(cls, path: str) -> Template:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.turn, self.sep, self.end = (max(ranks.values()) + 2 + i for i in range(3))
        assert self.end < 1 << 16

    def encode(self, text: str | None) -> list[int]:
        return self.coder.encode_ordinary(escape(text or ""))

    def decode(self, ids: np.ndarray) -> str:
        """The escaped text."""
        return self.coder.decode_bytes(ids.tolist()).decode()


_ENCODED = "conv_id long, turn long, role string, ids binary, loss_at long, loss_n long"
STORED = "conv_id long, part int, n_turns long, ids binary, mask binary"


def _encode(tokenizer: str, learned: str):
    def go(batches):
        t = Template.of(tokenizer)
        for batch in batches:
            ids, at, n = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                head = [t.turn, *t.encode(role), t.sep]
                body = t.encode(text)
                ids.append(np.array([*head, *body, t.end], np.uint16).tobytes())
                at.append(len(head))
                n.append(len(body) if role == learned else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(ids, pa.binary()), pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["conv_id", "turn", "role", "ids", "loss_at", "loss_n"])

    return go


def mask_of(length: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The loss mask of a sequence from its spans."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def _assemble(batches):
    conv, part, ids, at, n, size = ..., 0, [], [], [], 0
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n_turns", pa.int64()), ("ids", pa.binary()), ("mask", pa.binary())])

    def out():
        mask = mask_of(size, np.array(at, np.int64), np.array(n, np.int64))
        return pa.RecordBatch.from_pylist([{"conv_id": conv, "part": part, "n_turns": len(ids), "ids": b"".join(ids), "mask": np.packbits(mask).tobytes()}], schema=schema)

    for batch in batches:
        for c, x, a, m in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5)), strict=True):
            if ids and (c != conv or size >= PART_TOKENS):
                yield out()
                part = part + 1 if c == conv else 0
                ids, at, n, size = [], [], [], 0
            conv = c
            ids.append(x)
            at.append(size + a)
            n.append(m)
            size += len(x) // 2
    if ids:
        yield out()


def write_chats(turns: DataFrame, tokenizer: str | None = None, learned: str = "assistant", conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> str:
    """Formats every conversation and returns the folder of the written parts."""
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    coded = rows.mapInArrow(_encode(tokenizer or default_path(), learned), _ENCODED)
    path = scratch_path(turns.sparkSession, "chats")
    coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids").mapInArrow(_assemble, STORED).write.option("maxRecordsPerFile", 0).parquet(path)
    return path


def read_chats(spark, path: str, tokenizer: str | None = None) -> DataFrame:
    """Parses the stored parts back: one row per conversation with the digests of its turns and of the text under the loss mask."""
    tokenizer = tokenizer or default_path()

    def go(batches):
        t = Template.of(tokenizer)
        conv = ...
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        frame = len("".join(RESERVED))

        def out():
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([turns]), pa.array([all_.hexdigest()]), pa.array([loss_n]), pa.array([loss.hexdigest()]), pa.array([chars])], names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != conv:
                    if conv is not ...:
                        yield out()
                    conv, turns, loss_n, chars, all_, loss = row["conv_id"], 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                ids = np.frombuffer(row["ids"], np.uint16)
                mask = np.unpackbits(np.frombuffer(row["mask"], np.uint8), count=len(ids)).astype(bool)
                for a, s, e in zip(*(np.flatnonzero(ids == x).tolist() for x in (t.turn, t.sep, t.end)), strict=True):
                    role, text = t.decode(ids[a + 1 : s]), t.decode(ids[s + 1 : e])
                    turns, chars = turns + 1, chars + len(role) + len(text) + frame
                    plain = unescape(text)
                    all_.update(f"{unescape(role)}\n{plain}\n".encode())
                    under = mask[s + 1 : e]
                    if under.any():
                        learned = plain if under.all() else unescape(t.decode(ids[s + 1 : e][under]))
                        loss_n += len(learned)
                        loss.update(learned.encode())
        if conv is not ...:
            yield out()

    def opened(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                yield from go(file_batches([file], STORED, READ_PARTS))

    # a conversation's parts stand together, in order, in one file: a task reads whole files and nothing is shuffled
    files = spark.read.schema(STORED).parquet(path).inputFiles()
    rows = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    return rows.mapInArrow(opened, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
