"""The corpus pipeline: every stage applies one operator to all that the stage before it kept.

Each stage but the last returns the columns of the documents it was given,
whatever they are besides doc_id, text, lang and source: rows travel as one
struct, so no column of theirs can clash with a stage's own.  A stage deletes
the scratch tables of the stage before it, whose output has been written by
then; run() deletes each stage's table once the next is written.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import common, decontamination, grammar_output, language_id, mixing, ngram_join, queries

#: Scratch tables of the last stage of each run, by application, thread and input.
_left: dict[tuple, list[str]] = {}


def _stage(f, first: bool = False):
    def go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        run_ = (spark.sparkContext.applicationId, threading.get_ident(), sf_dir)
        done = _left.pop(run_, [])
        if not first:
            common.drop(spark, done)
        common.bound_batches(spark)
        with common.collected() as made:
            out = f(spark, docs, sf_dir)
        _left[run_] = made
        return out

    return go


def _rows(docs: DataFrame) -> DataFrame:
    """(row, id, body): the documents as structs, with what the stages look at."""
    every = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])
    return docs.select(every.alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("body"))


#: Ids or keys of dropped documents are broadcast up to this many (16 bytes each), else joined by a shuffle.
DROPPED_SENT = 1_000_000


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= DROPPED_SENT else table


def _language(spark, docs, sf_dir):
    """Documents that are null or have no letter go; others stay whatever the model says, also if there is none.

    Repeated rows and ties are judged one by one: each stays or goes by its own text.
    """
    held = F.coalesce(common.crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.fit(docs, held)
    return language_id.predict(_rows(docs).drop("id"), model, "body", ["row", "body"]).where((F.col("lang_pred") != "und") | F.col("body").rlike(r"\p{L}")).select("row.*")


def _near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more, and chains of such) the row with the smallest doc_id stays.

    Rows without an id and texts without a word stay.  Of the rows of one id
    and one text the first by all their columns' JSON stays; rows of one id
    with different texts stay or go by their groups.
    """
    found = ngram_join.jaccard_components(docs, k=5, num=80, den=100).where("doc_id is not null")
    by_id = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.max("component_id").alias("last"), F.count("*").alias("rows"))
    by_id = common.saved(by_id.where("component_id <> doc_id or last <> doc_id or rows > 1"), "groups")
    gone = by_id.where("component_id <> doc_id and last <> doc_id").select(F.col("doc_id").alias("gone"))
    rows = _rows(docs)
    out = rows.join(_sent(gone), F.col("id") == F.col("gone"), "left_anti")
    twice = by_id.where("rows > 1").select(F.col("doc_id").alias("twice"))
    if twice.isEmpty():
        return out.select("row.*")
    tagged = out.join(_sent(twice), F.col("id") == F.col("twice"), "left")
    single = tagged.where("twice is null").select("row")
    one = tagged.where("twice is not null").groupBy("id", "body").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return single.unionByName(one).select("row.*")


def _decontaminate(spark, docs, sf_dir):
    """Documents holding a passage of a benchmark item go.

    Texts that are null or empty hold none and stay.  Rows of one id and one
    text, repeated or not, go or stay together, whatever their other columns.
    """
    key = F.xxhash64("doc_id", "text")
    hits = decontamination.contamination(docs.select(key.alias("key"), "text"), common.table(spark, sf_dir, "benchmark"), window=10, doc_id="key")
    bad = common.saved(hits.where("contaminated").select(F.col("doc_id").alias("bad")).distinct(), "contaminated")
    rows = _rows(docs).withColumn("key", F.xxhash64("row.doc_id", "row.text"))
    return rows.join(_sent(bad), F.col("key") == F.col("bad"), "left_anti").select("row.*")


def _mix(spark, docs, sf_dir):
    """Documents are taken to target weights, up to twice, over a budget of all their tokens.

    Null languages and sources are leaves of their own; texts that are null or
    empty have no tokens and are taken if they start before their leaf's cut;
    rows of one id are taken together, each as often.
    """
    return mixing.mixed(docs, queries.mixture(1, 1))


def _tokens(spark, docs, sf_dir):
    """Token ids of every row, written and read back; null and empty texts have the end id alone, repeated rows and documents taken twice are written each, rows without an id come first."""
    return grammar_output.read_documents(spark, grammar_output.write_shards(docs, end_id=2))


STAGES = [
    ("language ID", _stage(_language, first=True)),
    ("n-gram Jaccard join", _stage(_near_duplicates)),
    ("benchmark decontamination", _stage(_decontaminate)),
    ("mixing sources to target weights", _stage(_mix)),
    ("token-ID output", _stage(_tokens)),
]

#: A tokenizer and a fitted classifier aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{common.shared_dir(spark)}/docloom/stage-{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            common.drop(spark, [before])
        docs, before = spark.read.parquet(path), path
    common.drop(spark, _left.pop((spark.sparkContext.applicationId, threading.get_ident(), sf_dir), []))
    return docs
