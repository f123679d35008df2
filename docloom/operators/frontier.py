"""The crawl frontier as a table: url, state (pending, visited, failed), reason, seq.

Steps are joins against the state; nothing is held in the driver but counts.
A failed URL isn't queued again.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import scalars as S

#: After so many levels their frames are made one.
LEVELS_JOINED = 16

STATE = "url string, state string, reason string, seq long"


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], STATE)


def enqueue(state: DataFrame, urls: DataFrame) -> DataFrame:
    """state with the new ones of urls (url, seq) pending: normalised, each once, the first seq."""
    new = urls.select(S.normalize_url(F.col("url"), strip_invalid=False).alias("url"), "seq").where(F.coalesce("url", F.lit("")) != "").groupBy("url").agg(F.min("seq").alias("seq"))
    fresh = new.join(state.select("url"), "url", "left_anti")
    return state.unionByName(fresh.select("url", F.lit("pending").alias("state"), F.lit(None).cast("string").alias("reason"), "seq"))


def next_batch(state: DataFrame, most: int) -> DataFrame:
    """The pending URLs queued first."""
    return state.where("state = 'pending'").orderBy("seq", "url").limit(most)


def mark(state: DataFrame, done: DataFrame) -> DataFrame:
    """state after visits: done has url, ok, reason."""
    d = done.select(F.col("url").alias("done_url"), "ok", F.col("reason").alias("why"))
    out = state.join(d, F.col("url") == F.col("done_url"), "left")
    return out.select("url", F.when(F.col("ok"), "visited").when(~F.col("ok"), "failed").otherwise(F.col("state")).alias("state"), F.when(~F.coalesce("ok", F.lit(True)), F.col("why")).otherwise(F.col("reason")).alias("reason"), "seq")


def snapshot(state: DataFrame) -> DataFrame:
    return state.groupBy("state").agg(F.count("*").alias("n"))


def restore(rows: DataFrame) -> DataFrame:
    """A saved state table, validated: rows without a URL or of an unknown state go, a URL's furthest state stands."""
    rank = F.when(F.col("state") == "visited", 2).when(F.col("state") == "failed", 1).otherwise(0)
    good = rows.where((F.col("url") != "") & F.col("state").isin("pending", "visited", "failed"))
    return good.groupBy(S.normalize_url(F.col("url"), strip_invalid=False).alias("url")).agg(F.max_by("state", rank).alias("state"), F.max_by("reason", rank).alias("reason"), F.min("seq").alias("seq"))


def reachable(links: DataFrame, seeds: DataFrame, max_depth: int | None = None, checkpoint=None) -> DataFrame:
    """(url, depth): breadth-first over links (src, dst) from seeds (url), each at its least depth.

    One superstep a level, ended when a level finds nothing new or at max_depth
    (None: no limit); checkpoint, a function of a frame and a name, cuts the
    lineage of each.
    """
    cut = checkpoint or (lambda df, name: df.checkpoint())
    seen = cut(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "seen")
    edge = seen
    for depth in itertools.count(1) if max_depth is None else range(1, max_depth + 1):
        found = links.join(edge.select(F.col("url").alias("src")), "src").select(F.col("dst").alias("url")).where("url is not null").distinct().join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth))
        edge = cut(found, "level")
        if edge.isEmpty():
            break
        seen = seen.unionByName(edge)
        if depth % LEVELS_JOINED == 0:
            seen = cut(seen, "seen")
    return seen


def progress_milestone(done: Column, total: Column, percent: int) -> Column:
    """Whether this many done is the first at or past the percentage."""
    step = F.ceil(total * percent / 100)
    return done == step


def numbered(urls: DataFrame, order: str) -> DataFrame:
    """urls with seq by order, for small seed lists."""
    return urls.withColumn("seq", F.row_number().over(Window.orderBy(order)).cast("long"))
