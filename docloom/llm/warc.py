"""WARC archives and their merged capture index.

Writing: each task writes gzip-per-record WARC files into the shared folder.
Of records with one payload of at least REVISIT_BYTES, the one with the
largest page id is the response and the others are revisits that refer to it;
smaller ones are all responses.  Each file yields a run: its captures sorted
by URL key, timestamp and id.

Index: the runs are merged externally.  A regular sample of the runs' keys, of
a size that the number of ranges sets, gives range bounds; each run is cut at
the bounds, and the task of a range merges its pieces of all runs by a loser
tree.  Key and id together bound the ranges, so a hot URL is spread over
several.  There are at most MAX_RANGES ranges, whatever the number of captures.

Null htmls are empty, null or odd URLs are percent-encoded (null: no target
and an empty key), rows without a page id are responses, repeated rows are
written each; in the index, captures of one key, time and id stand in the
order of their files' names.  A file's name is random and only files named in
committed run rows are read, so a lost executor leaves at most an unread file.
"""

from __future__ import annotations

import base64
import bisect
import datetime
import hashlib
import io
import itertools
import re
import uuid
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import saved, scratch_path

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
RANGE_CAPTURES = 4096
MAX_RANGES = 4096
SAMPLES_A_RANGE = 16
#: Digests of repeated payloads are broadcast up to this many (about 60 bytes each).
SENT = 200_000
#: Most tasks that read archives back.
READERS = 20_000
_EPOCH = datetime.datetime(2020, 1, 1)
_URN = "urn:docloom:page:"

RUNS = "file string, place long, key string, page_id long, length long, kind string"
CAPTURES = "part int, pos long, urlkey string, timestamp string, page_id long, kind string, file string, place long, length long"


def url_key(url: str | None) -> str:
    """Host labels reversed, without www and port, then the path and query in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = re.sub(r"^www\d*\.", "", (parts.hostname or "").lower())
    except ValueError:
        return url.strip().lower()
    return f"{','.join(reversed(host.split('.')))}){(parts.path or '/').lower()}{'?' + parts.query.lower() if parts.query else ''}"


def stamp(page_id: int | None) -> str:
    """14 digits: the given moment of a page's capture, a second per id."""
    return (_EPOCH + datetime.timedelta(seconds=(page_id or 0) % 3_000_000_000)).strftime("%Y%m%d%H%M%S")


def _sort_key(url: str | None, page_id: int | None) -> str:
    return f"{re.sub(r'[\x00-\x20]', '_', url_key(url))} {stamp(page_id)} {(page_id or 0) + (1 << 63):020d}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head alone."""
    when = datetime.datetime.strptime(stamp(page_id), "%Y%m%d%H%M%S").isoformat() + "Z"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>", f"WARC-Date: {when}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _qualified(spark, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", uri))


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives; returns the sorted runs (RUNS), one per file, from the shared folder."""
    spark = pages.sparkSession
    folder = _qualified(spark, scratch_path(spark, "warc"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.sha1("payload")))
    # digests and ids alone tell which payloads are repeated; a row without a digest has nothing to be joined with
    shared = rows.where("digest is not null and page_id is not null").groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    shared = saved(shared.where("n > 1").select(F.col("digest").alias("key"), "keeper"), "repeated")
    key = F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    typed = rows.withColumn("key", key).join(F.broadcast(shared) if shared.count() <= SENT else shared, "key", "left")
    typed = typed.select("page_id", "url", "payload", F.when(F.col("page_id") != F.col("keeper"), F.col("keeper")).alias("refers_to"))

    def write(batches):
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        sink, run, name, place = None, [], "", 0

        def out():
            sink.close()
            cols = list(zip(*sorted(run, key=lambda r: r[2]), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], [x.split()[0] for x in RUNS.split(", ")])

        for batch in batches:
            for i, u, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    name, place, run = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, []
                    sink = store.open_output_stream(_open(name)[1], compression=None)
                data = record(i, u, payload, hashlib.sha1(payload).digest(), refers)
                coder = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = coder.compress(data) + coder.flush()
                sink.write(packed)
                run.append((name, place, _sort_key(u, i), i, len(packed), "response" if refers is None else "revisit"))
                place += len(packed)
                if place >= file_bytes:
                    yield out()
                    sink = None
        if sink is not None:
            yield out()

    return saved(typed.mapInArrow(write, RUNS), "runs")


class LoserTree:
    """Merges sorted lists: inner nodes hold the losers, the root's winner is the next item."""

    def __init__(self, lists: list[list]):
        self.lists, self.at, self.k = lists, [0] * len(lists), len(lists)
        self.heads = [x[0] if x else None for x in lists]
        self.loser = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None and x is not None or x is not None and (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            other = self.loser[node]
            if other == -1:  # the first to come waits
                self.loser[node] = i
                return
            if self._less(other, i):
                self.loser[node], i = i, other
            node //= 2
        self.loser[0] = i

    def __iter__(self):
        while self.k and self.heads[i := self.loser[0]] is not None:
            yield i, self.at[i]
            self.at[i] += 1
            self.heads[i] = self.lists[i][self.at[i]] if self.at[i] < len(self.lists[i]) else None
            self._play(i)


def merge_runs(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The captures of all runs in one order, by URL key and timestamp: CAPTURES, ordered by (part, pos)."""
    n = runs.count()
    ranges = min(max(1, -(-n // range_captures)), MAX_RANGES)
    every = max(1, n // (ranges * SAMPLES_A_RANGE))

    def sample(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(range(every // 2, len(batch), every), pa.int64()))], ["key"])

    # each run comes in its own order, so every so many-th key of it is a regular sample; about SAMPLES_A_RANGE * ranges keys in all
    keys = sorted(r[0] for r in runs.select("key").mapInArrow(sample, "key string").collect()) if ranges > 1 else []
    bounds = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []

    def cut(batches):
        for batch in batches:
            rows = batch.to_pylist()
            i = 0
            while i < len(rows):
                part = bisect.bisect_right(bounds, rows[i]["key"])
                file = rows[i]["file"]
                j = i
                while j < len(rows) and rows[j]["file"] == file and (part == len(bounds) or rows[j]["key"] < bounds[part]):
                    j += 1
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, batch.schema) as w:
                    w.write_batch(batch.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([rows[i]["key"]]), pa.array([sink.getvalue()], pa.binary())], ["part", "run", "first", "rows"])
                i = j

    def merge(batches):
        pieces: dict[int, dict[str, list]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                pieces.setdefault(row["part"], {}).setdefault(row["run"], []).append((row["first"], row["rows"]))
        for part in sorted(pieces):
            # pieces stay packed as Arrow tables; the tree is given their keys, and its winners are taken a few thousand at a time
            opened = [pa.concat_tables(pa.ipc.open_stream(rows).read_all() for _, rows in sorted(x, key=lambda p: p[0])) for _, x in sorted(pieces.pop(part).items())]
            base = [0, *itertools.accumulate(map(len, opened))]
            whole, winners = pa.concat_tables(opened), iter(LoserTree([x.column("key").to_pylist() for x in opened]))
            pos = 0
            while chosen := [base[i] + k for i, k in itertools.islice(winners, 5000)]:
                out = whole.take(pa.array(chosen, pa.int64())).combine_chunks().to_batches()[0]
                split = [x.split(" ") for x in out.column("key").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(out), pa.int32()), pa.array(range(pos, pos + len(out)), pa.int64()), pa.array([x[0] for x in split]), pa.array([x[1] for x in split]),
                        *(out.column(c) for c in ("page_id", "kind", "file", "place", "length")),
                    ],
                    [x.split()[0] for x in CAPTURES.split(", ")],
                )
                pos += len(out)

    pieces = runs.mapInArrow(cut, "part int, run string, first string, rows binary")
    return pieces.repartitionById(ranges, F.col("part")).mapInArrow(merge, CAPTURES)


def _records(source):
    """(place, header dict, block) of each gzip member, streamed."""
    place, buffer = 0, b""
    while True:
        coder, out, size = zlib.decompressobj(31), [], 0
        while not coder.eof:
            if not buffer:
                buffer = source.read(1 << 20)
                if not buffer:
                    if size:
                        raise ValueError("a WARC file ends inside a record")
                    return
            out.append(coder.decompress(buffer))
            size += len(buffer) - len(coder.unused_data)
            buffer = coder.unused_data
        head, _, block = b"".join(out).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield place, fields, block[: int(fields["Content-Length"])]
        place += size


def read_archives(runs: DataFrame) -> DataFrame:
    """Every record of the archives that the runs name, parsed and checked: file, place, page_id, payload_bytes, payload_digest, record_type, refers_to."""
    files = runs.select("file").distinct()
    tasks = min(max(1, files.count()), READERS)  # a task reads whole files; the list of them is too short for Spark to deal it out by itself
    number = lambda x: int(x) if (x := x.strip("<>").removeprefix(_URN)) else None

    def read(batches):
        names = ["file", "place", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = _open(file)
                rows = []
                with store.open_input_stream(path, compression=None) as source:
                    for place, fields, block in _records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                        kind = fields["WARC-Type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
                            raise ValueError(f"damaged record at {place} of {file}")
                        rows.append((file, place, number(fields["WARC-Record-ID"]), size, digest.hex(), kind, number(fields["WARC-Refers-To"]) if kind == "revisit" else None))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.repartition(tasks).mapInArrow(read, "file string, place long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """Writes, indexes and reads back: each capture of the merged index with what its record says, its URL key, its time, its place in the index (part, pos) and the number of captures before it."""
    runs = write_archives(pages, page_id, url, html)
    found = read_archives(runs)
    index = saved(merge_runs(runs, range_captures).drop("page_id", "kind", "length"), "captures")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    parts = index.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    placed = index.join(F.broadcast(parts), "part").withColumn("place_in_index", F.col("earlier") + F.col("pos"))
    # both sides hold a row per record; Spark would take the records for as small as the list of files they come from
    out = placed.join(found.hint("merge"), ["file", "place"])
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "place_in_index", "part", "pos")
