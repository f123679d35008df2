"""Sinks: projections of documents and chunks, and the writers that store them."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import scalars as S

COLLECTION = "documents"
VECTOR_SIZE = 1536


def document_index(docs: DataFrame, base_url: Column) -> DataFrame:
    """id, title, domain, type, url, path of each document's JSON file."""
    name = S.document_filename(F.col("url"), F.col("title"), base_url, F.col("endpoint.path"), F.col("endpoint.method"), F.col("id"))
    return docs.select("id", "title", "domain", "type", "url", S.json_path(F.col("domain"), F.regexp_replace(name, r"\.md\z", ".json"), F.coalesce("storageSegments", F.expr("cast(array() as array<string>)"))).alias("path"))


def markdown_export(docs: DataFrame, base_url: Column) -> DataFrame:
    """path and value: front matter, markdown, and the endpoint's badge where its path isn't mentioned yet."""
    fields = {k: F.col(k) for k in ("domain", "subcategory", "title", "type", "version", "url", "id")}
    order = {k: fields.get(k, F.col(f"endpoint.{k}") if k in ("method", "path") else None) for k in ("domain", "subcategory", "title", "type", "method", "path", "version", "url", "id")}
    whole = F.concat(S.frontmatter(order, F.coalesce("authRequired", "endpoint.authRequired"), F.col("tags")), "markdown")
    name = S.document_filename(F.col("url"), F.col("title"), base_url, F.col("endpoint.path"), F.col("endpoint.method"), F.col("id"))
    return docs.select(S.markdown_path(F.col("domain"), name, F.coalesce("storageSegments", F.expr("cast(array() as array<string>)"))).alias("path"), S.with_badge(whole, F.col("endpoint.method"), F.col("endpoint.path")).alias("value"))


def generic_records(chunks: DataFrame) -> DataFrame:
    """One JSON line per chunk."""
    meta = F.map_concat(F.create_map(*[x for k, v in (("domain", "domain"), ("section", "section"), ("type", "type"), ("source_url", "sourceUrl"), ("document_id", "documentId")) for x in (F.lit(k), F.col(v))]), "metadata")
    return chunks.select(F.to_json(F.struct("id", F.col("content").alias("document"), meta.alias("metadata"), "embedding_hint")).alias("value"))


def chroma_rows(chunks: DataFrame) -> DataFrame:
    """The four parallel lists as rows; chroma_batches gathers bounded batches of them."""
    meta = F.map_concat(F.create_map(*[x for k, v in (("domain", "domain"), ("section", "section"), ("type", "type"), ("source_url", "sourceUrl"), ("document_id", "documentId"), ("embedding_hint", "embedding_hint")) for x in (F.lit(k), F.col(v))]), "metadata")
    return chunks.select("id", F.col("content").alias("document"), meta.alias("metadata"), "embedding_hint")


def chroma_batches(chunks: DataFrame, rows: int = 1000) -> DataFrame:
    """ids, documents, metadatas, embedding_hints of batches of about rows chunks, ordered by id inside."""
    n = chunks.count()
    batch = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // rows))))
    got = chroma_rows(chunks).groupBy(batch.alias("batch")).agg(F.array_sort(F.collect_list(F.struct("id", "document", "embedding_hint", F.map_entries("metadata").alias("m")))).alias("r"))
    return got.select("batch", F.col("r.id").alias("ids"), F.col("r.document").alias("documents"), F.transform("r", lambda x: F.map_from_entries(x["m"])).alias("metadatas"), F.col("r.embedding_hint").alias("embedding_hints"))


def chroma_meta(chunks: DataFrame, model: str = "text-embedding-3-small") -> DataFrame:
    return chunks.agg(F.lit(COLLECTION).alias("collection_name"), F.lit(model).alias("embedding_model"), F.count("*").alias("record_count"))


def qdrant_points(chunks: DataFrame) -> DataFrame:
    """id and payload of each chunk."""
    payload = F.map_concat(F.create_map(*[x for k, v in (("content", "content"), ("domain", "domain"), ("section", "section"), ("type", "type"), ("embedding_hint", "embedding_hint"), ("document_id", "documentId")) for x in (F.lit(k), F.col(v))]), "metadata")
    return chunks.select("id", payload.alias("payload"))


def qdrant_header() -> dict:
    return {"collection_name": COLLECTION, "vector_size": VECTOR_SIZE, "distance": "Cosine"}


def documents_summary(docs: DataFrame) -> DataFrame:
    return docs.select("id", "title", "domain", "type", F.substring(S.plain_text(F.col("markdown")), 1, 200).alias("preview"), F.concat("domain", F.lit(": "), "title", F.lit(" - "), F.coalesce("description", F.lit(""))).alias("embedding_text"))


def embedding_text(hint: Column, content: Column) -> Column:
    return F.concat_ws("\n\n", hint, content)


def write_documents(docs: DataFrame, folder: str) -> None:
    """JSON lines by domain, overwriting."""
    docs.withColumn("__domain", F.col("domain")).write.mode("overwrite").partitionBy("__domain").json(folder)


def write_chunks(chunks: DataFrame, folder: str) -> None:
    chunks.withColumn("__domain", F.col("domain")).write.mode("overwrite").partitionBy("__domain").json(folder)


#: Fields of a stored document, in the order they are written.
STORED = (
    "id", "title", "domain", "subcategory", "storageSegments", "type", "url", "content", "markdown", "description", "headings", "tables", "examples", "codeBlocks",
    "endpoint", "tags", "breadcrumbs", "contentHash", "extractedAt", "framework", "version", "authRequired", "extractionQuality", "extractionSignals",
)


def document_files(docs: DataFrame, path: Column) -> DataFrame:
    """path and value: a document's JSON, its fields in the order of STORED, those it lacks left out."""
    return docs.select(path.alias("path"), F.to_json(F.struct(*[F.col(c) for c in STORED if c in docs.columns]), {"pretty": "true"}).alias("value"))


def write_files(rows: DataFrame, folder: str) -> int:
    """One file per row (path, value) below folder, written where the rows are; returns how many.

    A file is written under a name of its own and then renamed, so a task that
    is run again leaves whole files.  Paths that leave the folder are refused.
    """

    def write(batches):
        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not path or path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"no path below the folder: {path!r}")
                at = f"{base}/{path}"
                store.create_dir(at.rpartition("/")[0], recursive=True)
                part = f"{at}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as f:
                    f.write((value or "").encode())
                store.move(part, at)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    uri = _uri(folder)
    return rows.select("path", "value").mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def remove_files(rows: DataFrame, folder: str) -> None:
    """Deletes the files named in path below folder, and the folders that are empty then."""

    def remove(batches):
        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if store.get_file_info(f"{base}/{path}").type == fs.FileType.File:
                    store.delete_file(f"{base}/{path}")
            yield batch

    def prune(batches):
        store, base = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                while path:
                    try:
                        if store.get_file_info(fs.FileSelector(f"{base}/{path}")):
                            break
                        store.delete_dir(f"{base}/{path}")
                    except FileNotFoundError:
                        pass  # another task was here
                    path = path.rpartition("/")[0]
            yield batch

    uri = _uri(folder)
    rows.select("path").mapInArrow(remove, "path string").write.format("noop").mode("overwrite").save()
    folders = rows.select(F.regexp_replace("path", r"/[^/]*$", "").alias("path")).distinct()
    folders.mapInArrow(prune, "path string").write.format("noop").mode("overwrite").save()


def _uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def store(docs: DataFrame, base_url: Column, folder: str) -> int:
    """A JSON and a markdown file per document at its path; returns how many files."""
    name = S.document_filename(F.col("url"), F.col("title"), base_url, F.col("endpoint.path"), F.col("endpoint.method"), F.col("id"))
    path = S.json_path(F.col("domain"), F.regexp_replace(name, r"\.md\z", ".json"), F.coalesce("storageSegments", F.expr("cast(array() as array<string>)")))
    return write_files(document_files(docs, path).unionByName(markdown_export(docs, base_url)), folder)


def chunk_files(chunks: DataFrame) -> DataFrame:
    """path and value: a JSON file per chunk."""
    return chunks.select(S.chunk_path(F.col("domain"), F.col("id")).alias("path"), F.to_json(F.struct(*chunks.columns)).alias("value"))


def write_lines(rows: DataFrame, folder: str) -> None:
    """The column value as text lines."""
    rows.select("value").write.mode("overwrite").text(folder)


def write_rows(rows: DataFrame, folder: str) -> None:
    """Any report, tree, state or graph table as JSON lines."""
    rows.write.mode("overwrite").json(folder)


def clean(spark, folders: list[str]) -> None:
    """Empties storage folders."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for f in folders:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(hadoop).delete(p, True)
