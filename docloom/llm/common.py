"""Shared folder, scratch tables and small helpers of the operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_scratch: list[str] = []
_collector: ContextVar[list[str] | None] = ContextVar("collector", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a fresh local one only where it is unset and all runs in one process (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        key = spark.sparkContext.applicationId
        base = _own.setdefault(key, "") or _own.__setitem__(key, tempfile.mkdtemp(prefix="docloom-")) or _own[key]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/docloom/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    if (made := _collector.get()) is not None:
        made.append(path)
    return path


@contextmanager
def collected():
    """The list of the scratch tables that this thread makes inside the with block."""
    made: list[str] = []
    token = _collector.set(made)
    try:
        yield made
    finally:
        _collector.reset(token)
        if (outer := _collector.get()) is not None:
            outer += made


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read from there: the lineage is cut and no executor's loss costs more than a reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str, small: int) -> tuple[DataFrame, int]:
    """saved() and its number of rows; up to small rows it is read as one partition, so that joins and sums of such tables need no shuffle."""
    seen = Observation()
    path = scratch_path(df.sparkSession, name)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    n = seen.get["n"]
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return (out.coalesce(1) if n <= small else out), n


def file_batches(uris: list[str], ddl: str, rows: int):
    """On an executor: the rows of Parquet files in the shared folder, file by file in their order, so many at a time."""
    names = [x.split()[0] for x in ddl.split(", ")]
    for uri in uris:
        store, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", uri))
        with store.open_input_file(path) as source:
            yield from pq.ParquetFile(source).iter_batches(rows, columns=names)


def drop(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hadoop).delete(p, True)
        if path in _scratch:
            _scratch.remove(path)


def reclaim(spark: SparkSession, paths: list[str]) -> None:
    """drop(), and the shuffle files of frames that nothing holds any more go too: Spark deletes them only after a collection in the driver."""
    drop(spark, paths)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def newest(paths: list[str], *names: str) -> set[str]:
    """The last made scratch table of each name."""
    return {own[-1] for n in names if (own := [p for p in paths if p.rpartition("/")[2].startswith(f"{n}-")])}


def release(spark: SparkSession) -> None:
    """Deletes every scratch table made so far; call it when the frames built on them have been written."""
    drop(spark, list(_scratch))


def bound_batches(spark: SparkSession, rows: int = 500, megabytes: int = 8) -> None:
    """Arrow batches of few rows and bytes: texts may be long, and a batch is held twice, by the JVM and by its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", megabytes << 20)


def lean(f):
    """f over Arrow batches; what a task has freed goes back to the system at its end, as a worker lives on for the next."""

    @functools.wraps(f)
    def go(batches):
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)

    return go


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_in_bytes(df: DataFrame, text: str) -> int:
    """File sizes where Catalyst knows them, else half the bytes of the text column."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 50 else (df.agg(F.sum(F.octet_length(text))).first()[0] or 0) // 2


def crc_mod(column: Column, n: int) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % n


def share_below(rows: int, n: int) -> int:
    """The bound below which 62-bit hashes of n rows must lie for about rows of them to be taken."""
    return (1 << 62) if n <= rows else (rows << 62) // n


def sampled(df: DataFrame, rows: int, *columns: str, seed: int) -> DataFrame:
    """About rows of df's rows, told by a hash of the columns; all of them if there are no more."""
    return df.where(F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 62)) < share_below(rows, df.count()))
