"""Sources: raw HTML caches, stored JSON documents with their markdown, navigation files, saved state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import rules
from docloom.functions import scalars as S


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than the cluster has cores is dealt out over them; any other stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page cache table: page_id, url, html."""
    return spread(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def html_files(spark: SparkSession, folder: str) -> DataFrame:
    """A cache of ``{domain}/{id}.html`` files: domain, id, html."""
    df = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(folder)
    name = F.col("_metadata.file_path")
    return df.select(F.regexp_extract(name, r"([^/]+)/[^/]+\.html$", 1).alias("domain"), F.regexp_extract(name, r"([^/]+)\.html$", 1).alias("id"), F.col("value").alias("html"))


def _relative(folder: str):
    at = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    return F.regexp_replace(at, r"^.*?\Q" + folder.rstrip("/").removeprefix("file://") + r"\E/", "")


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stored documents, one JSON object a file, index files left out: the document schema, filename, rel_path, path_domain, _corrupt_record."""
    schema = f"{schemas.DOCUMENT}, _corrupt_record string"
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    df = df.withColumn("rel_path", _relative(folder)).withColumn("filename", F.element_at(F.split("rel_path", "/"), -1))
    domain = F.when(F.size(F.split("rel_path", "/")) > 1, F.get(F.split("rel_path", "/"), F.lit(0))).otherwise("general")
    return df.where("filename <> 'index.json'").withColumn("path_domain", domain)


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """rel_stem, stored_markdown of a folder of .md files."""
    df = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(folder)
    return df.select(F.regexp_replace(_relative(folder), r"\.md$", "").alias("rel_stem"), F.col("value").alias("stored_markdown"))


def load_documents(spark: SparkSession, json_folder: str, markdown_folder: str | None = None) -> DataFrame:
    """Every stored document, ids and markdown filled in, with problem (null if valid)."""
    return hydrate(json_documents(spark, json_folder), markdown_files(spark, markdown_folder) if markdown_folder else None)


def hydrate(stored: DataFrame, markdown: DataFrame | None = None) -> DataFrame:
    """Missing ids from the file name, else the content hash; missing markdown from the sibling file, else empty."""
    if markdown is not None:
        stored = stored.withColumn("rel_stem", F.regexp_replace("rel_path", r"\.json$", "")).join(markdown, "rel_stem", "left").drop("rel_stem")
        text = F.coalesce("markdown", "stored_markdown", F.lit(""))
    else:
        text = F.coalesce("markdown", F.lit(""))
    out = stored.withColumn("id", rules.stored_id(F.col("id"), F.col("filename"), F.col("contentHash"))).withColumn("markdown", text).drop("stored_markdown")
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in out.columns else F.lit(False)
    return out.withColumn("problem", F.when(corrupt, "json").otherwise(rules.document_problem(out.columns)))


def split_valid(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid documents, quarantine)."""
    return docs.where("problem is null").drop("problem"), docs.where("problem is not null")


def navigation(spark: SparkSession, path: str) -> DataFrame:
    """A flat navigation JSON file or folder; none if it is missing."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(hadoop).exists(p):
        return spark.createDataFrame([], schemas.NAV)
    df = spark.read.schema(schemas.NAV).option("multiLine", True).json(path)
    return df.withColumn("ord", F.coalesce("ord", F.monotonically_increasing_id()))


def seen_keys(docs: DataFrame) -> DataFrame:
    """Hashes and URLs already stored, for resuming."""
    return docs.select("contentHash", S.normalize_url(F.col("url")).alias("url")).distinct()


def url_ids(docs: DataFrame) -> DataFrame:
    """id -> url of stored documents."""
    return docs.where("id is not null").groupBy("id").agg(F.max("url").alias("url"))
