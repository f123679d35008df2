"""Mixing sources to target weights over a domain-language-source tree, in DataFrame operations alone.

A token budget goes down the tree.  Among siblings it is shared by weight; a
node whose capacity (its tokens times max_epochs) is below its share gets the
capacity, and what it leaves is shared among its siblings by weight again.  A
node's capacity is that of its whole subtree, so a shortage moves to siblings
first and to an ancestor's siblings only when all siblings are full.

A leaf with budget b and t tokens takes b div t whole epochs and, of the next
epoch's seeded order, the documents that start before token b mod t.  Orders
are by md5(seed:epoch:id), so they need no sort of the corpus: rows are
counted in hash buckets, and only the bucket that holds the cut is ordered.  A
leaf of n rows has about sqrt(n) buckets of sqrt(n) rows: neither the sums nor
the rows that one task orders grow with the leaf as such.

Null languages and sources are leaves of their own, named ``(none)``; a null
id is hashed as the empty string.  Rows with one id are one unit of the order:
taken or left together.  Empty and null texts have no tokens; they are taken
if they start before the cut.  Weights must be 1 at least.  All shares are
whole tokens, rounded down, so a node's children get at most one token each
less than it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import saved

#: Leaves up to which their table is broadcast (about 100 bytes each).
SENT = 100_000
LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Mixture:
    """Weights by domain, language and source (others: 1), the SQL expression of a row's domain, and the budget as a share of all tokens."""

    domain: str
    domains: dict[str, int]
    langs: dict[str, int]
    sources: dict[str, int]
    budget_num: int
    budget_den: int
    max_epochs: int = 2
    seed: int = 17


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("long")


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def keyed(docs: DataFrame, mixture: Mixture, lang: str = "lang", source: str = "source") -> list[Column]:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    return [F.coalesce(F.expr(mixture.domain), F.lit("(none)")).alias("domain"), named(lang).alias("lang"), named(source).alias("source")]


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """nodes (cap, weight, above: the parent's budget) with their own budget."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    name = next(k for k in LEAF if k not in parent)
    order = group.orderBy(F.col("cap") / F.col("weight"), name)
    wide = lambda c: c.cast("decimal(20,0)")
    nodes = nodes.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    nodes = nodes.withColumn("full", wide(F.col("cap")) * wide(F.col("from")) <= wide(F.col("above") - F.col("before")) * wide(F.col("weight")))
    nodes = nodes.withColumn("rest", F.col("above") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group)).withColumn("shares", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group))
    share = F.expr("cast(rest as decimal(20,0)) * cast(weight as decimal(20,0)) div cast(shares as decimal(20,0))")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop("before", "from", "full", "rest", "shares")


def budgets(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """Per leaf: docs, tokens, budget."""
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = saved(leaves, "leaves").withColumn("cap", F.col("tokens") * mixture.max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap"))
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {mixture.budget_num} div {mixture.budget_den}").alias("above"))
    domains = _filled(domains.withColumn("weight", _weight("domain", mixture.domains)).join(F.broadcast(total)), [])  # one row
    langs = _filled(langs.withColumn("weight", _weight("lang", mixture.langs)).join(domains.select("domain", F.col("budget").alias("above")), "domain"), ["domain"])
    out = _filled(leaves.withColumn("weight", _weight("source", mixture.sources)).join(langs.select("domain", "lang", F.col("budget").alias("above")), ["domain", "lang"]), ["domain", "lang"])
    return out.select(*LEAF, "docs", "tokens", "budget")


def _sent(table: DataFrame) -> DataFrame:
    """A written table of a row per leaf, broadcast where it is small: rows of a hot leaf then stay where they are."""
    return F.broadcast(table) if table.count() <= SENT else table


def _key(seed: int) -> Column:
    """The place of a row in its leaf's cut epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def plan(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """Per leaf: budget, epochs (whole ones), rest (tokens of the next), last (the key of the document at the cut), cut_start."""
    leaves = budgets(rows, mixture).withColumn("epochs", F.expr("case when tokens > 0 then budget div tokens else 0 end")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    leaves = saved(leaves, "budgets")
    open_ = leaves.where("rest > 0").select(*LEAF, "epochs", "rest", F.ceil(F.sqrt("docs")).alias("buckets"))
    placed = rows.join(_sent(open_), LEAF).withColumn("key", _key(mixture.seed))
    placed = placed.withColumn("bucket", F.expr("cast(conv(substring(key, 1, 8), 16, 10) as bigint) * buckets div 4294967296"))
    by = placed.groupBy(*LEAF, "bucket", "rest").agg(F.sum("n_tokens").alias("t"))
    order = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = by.withColumn("base", F.coalesce(F.sum("t").over(order), F.lit(0))).where("base < rest and rest <= base + t").select(*LEAF, "bucket", "base")
    edge = saved(edge, "edge")  # a row per leaf: where these are few, no row of the corpus moves for it
    units = placed.join(_sent(edge), [*LEAF, "bucket"]).groupBy(*LEAF, "key", "rest", "base").agg(F.sum("n_tokens").alias("t"))
    order = Window.partitionBy(*LEAF).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = units.withColumn("cut_start", F.col("base") + F.coalesce(F.sum("t").over(order), F.lit(0))).where("cut_start < rest and rest <= cut_start + t")
    return saved(leaves.join(cut.select(*LEAF, F.col("key").alias("last"), "cut_start"), LEAF, "left"), "plan")


def counted(rows: DataFrame, plan: DataFrame, mixture: Mixture) -> DataFrame:
    """rows (doc_id and leaf columns) with budget, epochs and copies: how many times a document is taken."""
    out = rows.join(_sent(plan.select(*LEAF, "budget", "epochs", "rest", "last", "cut_start")), LEAF).withColumn("key", _key(mixture.seed))
    return out.withColumn("copies", F.col("epochs") + F.when((F.col("rest") > 0) & (F.col("key") <= F.col("last")), 1).otherwise(0))


def select(docs: DataFrame, mixture: Mixture, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per document: doc_id, leaf, n_tokens, budget of the leaf, epochs, copies, tokens_taken (at the cut, what the prefix still holds)."""
    rows = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), *keyed(docs, mixture, lang, source), tokens(F.col(text)).alias("n_tokens")), "tokens")
    out = counted(rows, plan(rows, mixture), mixture)
    part = F.when(F.col("rest") <= 0, 0).when(F.col("key") < F.col("last"), F.col("n_tokens")).when(F.col("key") == F.col("last"), F.least(F.col("n_tokens"), F.col("rest") - F.col("cut_start"))).otherwise(0)
    return out.select("doc_id", *LEAF, "n_tokens", F.col("budget").alias("leaf_budget"), "epochs", "copies", (F.col("epochs") * F.col("n_tokens") + part).alias("tokens_taken"))


def mixed(docs: DataFrame, mixture: Mixture, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents of the mixture, whole and with all their columns, each as often as it is taken."""
    rows = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), *keyed(docs, mixture, lang, source), tokens(F.col(text)).alias("n_tokens")), "tokens")
    found = plan(rows, mixture)
    every = [f"`{c}`" for c in docs.columns]
    held = docs.select(F.struct(*every).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), *keyed(docs, mixture, lang, source))
    return counted(held, found, mixture).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def sql(mixture: Mixture) -> str:
    """DuckDB SQL for select() over documents."""
    case = lambda c, w: f"CASE {' '.join(f"WHEN {c} = '{k}' THEN {v}" for k, v in w.items())} ELSE 1 END" if w else "1"

    def fill(src: str, out: str, parent: str, name: str, weight: str) -> str:
        p = f"PARTITION BY {parent}" if parent else ""
        o = f"{p} ORDER BY cap / w, {name}"
        return f"""{out}0 AS (SELECT *, {weight} AS w FROM {src}),
{out}1 AS (SELECT *, coalesce(sum(cap) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER ({o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fromw FROM {out}0),
{out}2 AS (SELECT *, cap * fromw <= (above - before) * w AS full_ FROM {out}1),
{out}3 AS (SELECT *, above - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ({p}) AS left_, sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({p}) AS ws FROM {out}2),
{out} AS (SELECT * EXCLUDE (w, before, fromw, full_, left_, ws, above), CASE WHEN full_ THEN cap ELSE (left_ * w) // ws END AS budget FROM {out}3)"""

    return f"""
WITH r AS (SELECT doc_id, {mixture.domain} AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {mixture.max_epochs} AS cap FROM r GROUP BY ALL),
lang AS (SELECT domain, lang, sum(cap) AS cap FROM leaf GROUP BY ALL),
dom AS (SELECT domain, sum(cap) AS cap, (SELECT (sum(tokens) * {mixture.budget_num}) // {mixture.budget_den} FROM leaf) AS above FROM lang GROUP BY domain),
{fill("dom", "domb", "", "domain", case("domain", mixture.domains))},
langa AS (SELECT lang.*, domb.budget AS above FROM lang JOIN domb USING (domain)),
{fill("langa", "langb", "domain", "lang", case("lang", mixture.langs))},
leafa AS (SELECT leaf.*, langb.budget AS above FROM leaf JOIN langb USING (domain, lang)),
{fill("leafa", "leafb", "domain, lang", "source", case("source", mixture.sources))},
p AS (SELECT r.*, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM r JOIN leafb USING (domain, lang, source)),
q AS (SELECT *, md5('{mixture.seed}:' || CAST(epochs AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM p),
s AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM q)
SELECT doc_id, domain, lang, source, n_tokens, CAST(budget AS BIGINT) AS leaf_budget, CAST(epochs AS BIGINT) AS epochs, CAST(epochs + (CASE WHEN start < rest THEN 1 ELSE 0 END) AS BIGINT) AS copies,
  CAST(epochs * n_tokens + greatest(0, least(n_tokens, rest - start)) AS BIGINT) AS tokens_taken FROM s"""
