"""Incremental ingest: arriving raw pages are parsed, deduplicated against the store and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import corpus, pages

PAGE_SCHEMA = "page_id long, url string, html string"


def stream_pages(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def ingest(source: DataFrame, store: str, checkpoint: str):
    """Starts the query that appends documents of unseen content to the Parquet folder store; returns it.

    Within a batch the smallest page id wins, across batches the earlier one.
    A batch writes to a folder of its own number, so a batch that is run again
    after a failure replaces its own rows and nothing is stored twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = corpus.dedupe_content(pages.documents(pages.parse_pages(batch)), "ord")
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(store)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            stored = spark.read.parquet(store)
            if "batch" in stored.columns:
                new = corpus.unseen(new, stored.where(F.col("batch") != number))
        new.select(*[c for c in new.columns]).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
