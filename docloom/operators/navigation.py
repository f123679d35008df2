"""Navigation rows: indexes, merges, joins with documents, and the crawl's missing pages.

A navigation tree is kept as rows with their whole slug path, so recursive
merges are joins on that path.  ``ord`` is the order of discovery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import scalars as S

def _one_by_url(nav: DataFrame, pick, key: Column) -> DataFrame:
    """One row of each key, whole: a reduction, so a URL of any frequency is no burden."""
    names = nav.columns
    return nav.where(F.coalesce("url", F.lit("")) != "").groupBy(key.alias("norm_url")).agg(pick(F.struct(*names), F.col("ord")).alias("row")).select("norm_url", "row.*")


def url_index(nav: DataFrame) -> DataFrame:
    """Normalised URL -> navigation row, the last one winning."""
    return _one_by_url(nav, F.max_by, S.normalize_url(F.col("url")))


def crawl_index(nav: DataFrame) -> DataFrame:
    """URL less a trailing slash -> navigation row, the first one winning."""
    return _one_by_url(nav, F.min_by, F.regexp_replace("url", r"/\z", ""))


def merge_flat(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union by normalised URL; target before incoming, then the first of each."""
    both = target.withColumn("rank", F.struct(F.lit(0), F.col("ord"))).unionByName(incoming.withColumn("rank", F.struct(F.lit(1), F.col("ord"))))
    names = [c for c in both.columns if c != "rank"]
    return both.groupBy(S.normalize_url(F.col("url")).alias("norm_url")).agg(F.min_by(F.struct(*names), F.col("rank")).alias("row")).select("norm_url", "row.*")


def domain_order(nav: DataFrame) -> DataFrame:
    """Root domains by first appearance: domain, first."""
    return nav.where("depth = 0").groupBy("domain").agg(F.min("ord").alias("first"))


def assign_hierarchy(docs: DataFrame, nav: DataFrame) -> DataFrame:
    """Documents with domain and subcategory of their navigation row, where there is one."""
    index = url_index(nav).select("norm_url", F.col("domain").alias("nav_domain"), F.coalesce("parentSlug", "slug").alias("nav_sub"))
    out = docs.withColumn("norm_url", S.normalize_url(F.col("url"))).join(index, "norm_url", "left")
    return out.withColumn("domain", F.coalesce("nav_domain", "domain")).withColumn("subcategory", F.coalesce("nav_sub", "subcategory")).drop("norm_url", "nav_domain", "nav_sub")


def inner_segments(path: Column) -> Column:
    """What lies between a path's domain and its leaf."""
    return F.when(F.size(path) > 2, F.slice(path, 2, F.size(path) - 2)).otherwise(F.expr("cast(array() as array<string>)"))


def resolve_domain(url: Column, base_url: Column, nav: Column | None = None) -> tuple[Column, Column]:
    """(domain, subcategory) by navigation, else by URL."""
    by_url = S.domain_from_url(url, base_url), S.safe_slug(S.slug_from_url(url, base_url), 48)
    if nav is None:
        return by_url
    inner = inner_segments(nav["navPath"])
    sub = F.coalesce(F.when(F.size(inner) > 0, F.element_at(inner, -1)), F.when(F.coalesce(F.size(nav["navPath"]), F.lit(0)) <= 2, nav["parentSlug"]), nav["slug"])
    return F.when(nav.isNotNull(), nav["domain"]).otherwise(by_url[0]), F.when(nav.isNotNull(), sub).otherwise(by_url[1])


def storage_location(docs: DataFrame, nav: DataFrame, base_url: Column) -> DataFrame:
    """docs (url, domain, title) with loc_domain, loc_segments, loc_filename, loc_breadcrumbs, loc_subcategory."""
    index = url_index(nav).select("norm_url", F.col("navPath").alias("np"), F.col("pathTitles").alias("pt"))
    out = docs.withColumn("norm_url", S.normalize_url(F.col("url"))).join(index, "norm_url", "left")
    hit, page, np = F.coalesce(F.size("np"), F.lit(0)) >= 1, S.slug_from_url(F.col("url"), base_url), F.col("np")
    segments = F.when(hit, inner_segments(np)).otherwise(F.expr("cast(array() as array<string>)"))
    domain = F.when(hit, F.get(np, F.lit(0))).otherwise(F.col("domain"))
    leaf = F.element_at(np, -1)
    worded = F.concat(F.array(domain), F.transform(segments, lambda s: F.replace(s, F.lit("-"), F.lit(" "))), F.array(F.col("title")))
    crumbs = F.when(hit & (F.coalesce(F.size("pt"), F.lit(0)) > 0), F.col("pt")).when(hit, worded).otherwise(F.array(S.domain_title(F.col("domain")), F.col("title")))
    return out.select(
        *docs.columns, domain.alias("loc_domain"), segments.alias("loc_segments"), F.concat(F.when(hit, leaf).otherwise(F.coalesce(S.blank_as_null(page), S.url_hash(F.col("url")))), F.lit(".json")).alias("loc_filename"),
        F.filter(crumbs, lambda c: F.coalesce(c, F.lit("")) != "").alias("loc_breadcrumbs"), F.when(hit, F.when(F.size(segments) > 0, F.element_at(segments, -1)).otherwise(leaf)).otherwise(page).alias("loc_subcategory"),
    )


def uncrawled(nav: DataFrame, crawled_ids: DataFrame, base_url: Column, docs_host: str | None = None) -> DataFrame:
    """Distinct crawlable navigation URLs without a page of that id: url, id."""
    wanted = nav.select(S.normalize_url(F.col("url")).alias("url"), base_url.alias("b")).where(rules.should_crawl(F.col("url"), F.col("b"), docs_host)).select("url", S.url_hash(F.col("url")).alias("id")).distinct()
    return wanted.join(crawled_ids.select("id"), "id", "left_anti")


def supplement(nav: DataFrame, links: DataFrame, base_url: Column) -> DataFrame:
    """nav with rows of its own for links (url, title, ord) that it lacks: domain and slug by URL, at the root."""
    known = nav.select(S.normalize_url(F.col("url")).alias("norm_url")).distinct()
    new = links.withColumn("norm_url", S.normalize_url(F.col("url"))).join(known, "norm_url", "left_anti").groupBy("norm_url").agg(F.min_by(F.struct("title", "ord"), "ord").alias("first"))
    slug, domain = S.slug_from_url(F.col("norm_url"), base_url), S.domain_from_url(F.col("norm_url"), base_url)
    rows = new.select(F.col("norm_url").alias("url"), F.coalesce(S.blank_as_null(F.col("first.title")), S.humanize_slug(slug)).alias("title"), slug.alias("slug"), domain.alias("domain"), F.lit(0).alias("depth"), F.lit(0).alias("order"), F.lit(None).cast("string").alias("parentSlug"), F.array(domain).alias("navPath"), F.array(S.domain_title(domain)).alias("pathTitles"), "first.ord")
    return nav.unionByName(rows)


def resolve_ids(pages: DataFrame, known: DataFrame) -> DataFrame:
    """pages (id, ...) with the URL that has this id; unmatched rows keep a null url."""
    return pages.join(known.select(S.url_hash(F.col("url")).alias("id"), F.col("url").alias("resolved_url")).groupBy("id").agg(F.max("resolved_url").alias("resolved_url")), "id", "left")


def merge_tree(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Trees as rows (path, title, url, depth, order): outer merge on the slug path; the target wins, its gaps are filled."""
    a = target.select("path", *[F.col(c).alias(f"a_{c}") for c in ("title", "url", "depth", "order")])
    b = incoming.select("path", *[F.col(c).alias(f"b_{c}") for c in ("title", "url", "depth", "order")])
    out = a.join(b, "path", "full")
    return out.select("path", F.coalesce(S.blank_as_null(F.col("a_title")), "b_title").alias("title"), F.coalesce("a_url", "b_url").alias("url"), F.coalesce("a_depth", "b_depth").alias("depth"), F.coalesce("a_order", "b_order").alias("order"))


def tree_rows(nav: DataFrame) -> DataFrame:
    """Navigation rows as tree rows; of equal paths the last stands."""
    return nav.groupBy(F.col("navPath").alias("path")).agg(*[F.max_by(c, "ord").alias(c) for c in ("title", "url", "depth", "order")])


def flatten_tree(tree: DataFrame) -> DataFrame:
    """Tree rows with a URL, as navigation rows; ord is their place in depth-first order, by (order, slug) among siblings.

    A node's key is the (order, slug) of every node on its path; the window
    over all domains holds one row a domain.
    """
    step = tree.select("path", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("k"))
    above = tree.select(F.col("path").alias("prefix"), F.col("order").alias("at"))
    step = step.withColumn("prefix", F.expr("slice(path, 1, k)")).join(above, "prefix", "left")
    key = F.transform(F.array_sort(F.collect_list(F.struct("k", "at", F.element_at("prefix", -1).alias("slug")))), lambda x: F.struct(x["at"].alias("at"), x["slug"].alias("slug")))
    keys = step.groupBy(F.col("path").alias("key_path")).agg(key.alias("key"))
    rows = tree.where("url is not null").join(keys, F.col("path") == F.col("key_path"))
    first = F.get("key", F.lit(0))
    domains = rows.select(F.get("path", F.lit(0)).alias("key_domain"), first.alias("root")).distinct()
    domains = domains.withColumn("rank", F.row_number().over(Window.orderBy("root")))
    rows = rows.join(domains.drop("root"), F.get("path", F.lit(0)) == F.col("key_domain"))
    inside = F.row_number().over(Window.partitionBy("key_domain").orderBy("key"))
    return rows.select(
        "url", "title", F.element_at("path", -1).alias("slug"), F.get("path", F.lit(0)).alias("domain"), "depth", "order",
        F.when(F.size("path") > 1, F.element_at("path", -2)).alias("parentSlug"), F.col("path").alias("navPath"), (F.shiftleft(F.col("rank").cast("long"), 32) + inside).alias("ord"),
    )


def folders(tree: DataFrame) -> DataFrame:
    """Slugs of each domain's titles: domain, slugs (by path)."""
    named = tree.where("size(path) > 1 or url is not null").select(F.get("path", F.lit(0)).alias("domain"), "path", S.slugify(F.col("title")).alias("slug"))
    return named.groupBy("domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "slug"))), lambda x: x["slug"]).alias("slugs"))


def under_domain(nav: DataFrame, domain: str) -> DataFrame:
    """A sidebar's rows moved under a domain."""
    title = S.domain_title(F.lit(domain))
    return nav.withColumn("domain", F.lit(domain)).withColumn("navPath", F.concat(F.array(F.lit(domain)), F.coalesce("navPath", F.array("slug")))).withColumn("pathTitles", F.concat(F.array(title), F.coalesce("pathTitles", F.array("title"))))


def sort_by_nav(docs: DataFrame, nav: DataFrame) -> DataFrame:
    """Documents with nav_rank (999 where the domain has no root), sorted by it and then by title as people read."""
    ranks = domain_order(nav).withColumn("nav_rank", F.row_number().over(Window.orderBy("first")) - 1).select("domain", "nav_rank")  # one row a domain
    return docs.join(ranks, "domain", "left").withColumn("nav_rank", F.coalesce("nav_rank", F.lit(999))).orderBy("nav_rank", F.expr("collate(title, 'UNICODE')"))


def domain_slugs(urls: DataFrame, base_url: Column, known: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
    """Portal domains among URLs' first segments, those known and those named v1-...: slug, rank (by order, then by known; 999 for others)."""
    first = F.get(F.filter(F.split(S.url_path(F.col("url")), "/"), lambda s: s != ""), F.lit(0))
    places = [*order, *(k for k in known if k not in order)]
    rank = F.array_position(F.array(*[F.lit(d) for d in places]), F.col("slug"))
    found = urls.where(S.is_url(F.col("url"))).select(first.alias("slug")).where(F.startswith("slug", F.lit("v1-")) | F.col("slug").isin(*known)).distinct()
    return found.withColumn("rank", F.when(rank == 0, 999).otherwise(rank - 1).cast("int"))
