"""The document operators as registered queries, each over whole tables, with independent SQL where SQL expresses it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import scalars as S
from docloom.operators import api, chunks, corpus, frontier, navigation, pages
from docloom.plans import duck as D
from docloom.plans import pipeline
from docloom.plans.catalogue import register
from docloom.sources import readers, writers


def _t(spark, d, name) -> DataFrame:
    return readers.spread(spark.read.parquet(f"{d}/{name}.parquet"))


def _own(c="url"):
    return S.url_origin(F.col(c))


# pages, without the parser

_H1 = r"<h1>([\s\S]*?)</h1>"


def _unescaped(c):
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _page_docs(spark, d) -> DataFrame:
    """Light documents of the pages: no tree, only what the source and the URL say."""
    p = _t(spark, d, "pages")
    title = _unescaped(F.regexp_extract("html", _H1, 1))
    base = _own()
    return p.select(
        F.col("page_id").alias("ord"), S.url_hash(F.col("url")).alias("id"), "url", title.alias("title"), S.domain_from_url(F.col("url"), base).alias("domain"), S.safe_slug(S.slug_from_url(F.col("url"), base), 48).alias("subcategory"),
        rules.document_type(F.lit(False), title, F.col("url")).alias("type"), F.col("html").alias("content"), S.content_hash(F.col("html")).alias("contentHash"),
    )


_PAGES = f"""(SELECT page_id AS ord, {D.url_hash("url")} AS id, url, {D.h1()} AS title, {D.url_domain("url")} AS domain, {D.safe_slug(D.url_slug("url"), 48)} AS subcategory,
  {D.page_type(D.h1(), "url")} AS type, html AS content, {D.content_hash("html")} AS "contentHash" FROM pages)"""


@register("page_identity", f"SELECT ord AS page_id, id, {D.norm_url('url')} AS norm_url, {D.url_slug('url')} AS slug, domain, \"contentHash\" AS content_hash FROM {_PAGES}")
def page_identity(spark, d):
    return _page_docs(spark, d).select(F.col("ord").alias("page_id"), "id", S.normalize_url(F.col("url")).alias("norm_url"), S.slug_from_url(F.col("url"), _own()).alias("slug"), "domain", F.col("contentHash").alias("content_hash"))


@register(
    "page_framework",
    "SELECT page_id, CASE " + " ".join(f"WHEN regexp_matches(html, '{p}') THEN '{n}'" for n, p in rules.FRAMEWORKS) + " ELSE 'unknown' END AS framework FROM pages",
)
def page_framework(spark, d):
    return _t(spark, d, "pages").select("page_id", rules.framework(F.col("html")).alias("framework"))


@register("page_type", f"SELECT ord AS page_id, title, type FROM {_PAGES}")
def page_type(spark, d):
    return _page_docs(spark, d).select(F.col("ord").alias("page_id"), "title", "type")


@register(
    "domain_registry",
    f"""WITH p AS {_PAGES}, s AS (SELECT domain, subcategory, min(ord) AS f FROM p GROUP BY ALL)
SELECT domain, {D.capitalised("domain")} AS title, count(*) AS page_count, count(*) FILTER (type = 'endpoint') AS endpoint_count, (SELECT string_agg(subcategory, ',' ORDER BY f, subcategory) FROM s WHERE s.domain = p.domain) AS subcategories FROM p GROUP BY domain""",
)
def domain_registry(spark, d):
    return corpus.domain_registry(_page_docs(spark, d), "ord").select("domain", "title", F.col("pageCount").alias("page_count"), F.col("endpointCount").alias("endpoint_count"), F.array_join("subcategories", ",").alias("subcategories"))


@register("crawl_summary", f"SELECT count(*) AS documents, count(DISTINCT domain) AS domains, count(*) FILTER (type = 'endpoint') AS endpoints, 0::BIGINT AS nav_pages, count(*) AS visited, 0::BIGINT AS failed, 0::BIGINT AS intercepted FROM {_PAGES}")
def crawl_summary(spark, d):
    out = corpus.crawl_summary(_page_docs(spark, d))
    return out.select("documents", "domains", "endpoints", F.col("navPages").alias("nav_pages"), F.col("documents").alias("visited"), "failed", F.col("interceptedApis").alias("intercepted"))


@register(
    "storage_paths",
    f"""WITH p AS {_PAGES}, n AS (SELECT *, {D.url_slug("url")} AS us, {D.safe_slug("title", 40)} AS ts FROM p),
f AS (SELECT *, coalesce(CASE WHEN us NOT IN ('', 'index', 'page', 'inicio') THEN us END, CASE WHEN ts NOT IN ('', 'untitled', 'page', '200') THEN ts END, id) || '-' || id AS base FROM n),
g AS (SELECT *, CASE WHEN length(base) <= 100 THEN base ELSE id || '-' || id END AS name FROM f)
SELECT id, name || '.md' AS filename, 'json/' || {D.safe_slug("domain", 80)} || '/' || {D.safe_slug("name", 120)} || '.json' AS json_path, 'markdown/' || {D.safe_slug("domain", 80)} || '/' || {D.safe_slug("name", 120)} || '.md' AS markdown_path,
 'raw-html/' || {D.safe_slug("domain", 80)} || '/' || id || '.html' AS raw_path FROM g""",
)
def storage_paths(spark, d):
    none, no_path = F.lit(None).cast("string"), F.expr("cast(array() as array<string>)")
    p = _page_docs(spark, d).withColumn("filename", S.document_filename(F.col("url"), F.col("title"), _own(), none, none, F.col("id")))
    name = F.col("filename")
    return p.select("id", "filename", S.json_path(F.col("domain"), F.regexp_replace(name, r"\.md\z", ".json"), no_path).alias("json_path"), S.markdown_path(F.col("domain"), name, no_path).alias("markdown_path"), S.raw_html_path(F.col("domain"), F.col("id")).alias("raw_path"))


@register(
    "html_text",
    f"SELECT page_id, t AS text, length(t) < 20 AS is_empty FROM (SELECT page_id, {D.trim(D.chain('html', ('(?i)<script[\\s\\S]*?</script>', ''), ('(?i)<style[\\s\\S]*?</style>', ''), ('<[^>]+>', ' '), ('\\s+', ' ')))} AS t FROM pages)",
)
def html_text(spark, d):
    return _t(spark, d, "pages").select("page_id", S.strip_html(F.col("html")).alias("text"), S.is_empty_content(F.col("html")).alias("is_empty"))


@register("page_dedupe", f"SELECT min(ord) AS page_id, \"contentHash\" AS content_hash FROM {_PAGES} GROUP BY 2")
def page_dedupe(spark, d):
    return corpus.dedupe_content(_page_docs(spark, d), "ord").select(F.col("ord").alias("page_id"), F.col("contentHash").alias("content_hash"))


@register("resume_skip", f"WITH p AS {_PAGES} SELECT ord AS page_id FROM p WHERE \"contentHash\" NOT IN (SELECT \"contentHash\" FROM p WHERE ord % 3 = 0)")
def resume_skip(spark, d):
    p = _page_docs(spark, d)
    return corpus.unseen(p, p.where("ord % 3 = 0")).select(F.col("ord").alias("page_id"))


# pages, parsed


@register("page_parse", f"SELECT page_id, 'unknown' AS framework, {D.ws(D.h1())} AS title, 1::INTEGER AS headings, CAST((SELECT count(DISTINCT url) FROM {D.LINKS} l WHERE l.page_id = p.page_id) AS INTEGER) AS links FROM pages p")
def page_parse(spark, d):
    return pages.parse_pages(_t(spark, d, "pages")).select(F.col("ord").alias("page_id"), "framework", "title", F.size("headings").alias("headings"), F.size("links").alias("links"))


_PAGE_DOCUMENTS = f"""SELECT page_id AS ord, {D.url_hash("url")} AS id, title, domain, subcategory, type, url, content, markdown, CASE WHEN {D.is_placeholder("first")} THEN first ELSE {D.trim("first")} END AS description, 1::INTEGER AS n_headings,
  domain || ',' || type || CASE WHEN subcategory <> domain THEN ',' || subcategory ELSE '' END AS tags, {D.content_hash("content")} AS "contentHash", 'unknown' AS framework,
  CASE WHEN bad AND held THEN 'failed' WHEN bad OR held THEN 'partial' ELSE 'complete' END AS "extractionQuality", 20::INTEGER AS score, 'broken' AS grade
  FROM (SELECT *, {D.title_bad("title")} AS bad, {D.placeholder("content")} OR {D.placeholder("markdown")} AS held FROM {D.DOCUMENTS})"""


@register("page_documents", _PAGE_DOCUMENTS)
def page_documents(spark, d):
    out = pipeline.rebuild(_t(spark, d, "pages"))
    return out.select("ord", "id", "title", "domain", "subcategory", "type", "url", "content", "markdown", "description", F.size("headings").alias("n_headings"), F.array_join("tags", ",").alias("tags"), "contentHash", "framework", "extractionQuality", F.col("qualityScore.score").alias("score"), F.col("qualityScore.grade").alias("grade"))


@register("page_links", f"SELECT DISTINCT page_id, url FROM {D.LINKS}")
def page_links(spark, d):
    return pages.parse_pages(_t(spark, d, "pages"), only=("links",)).select(F.col("ord").alias("page_id"), F.explode("links").alias("url"))


@register("crawlable_links", f"SELECT DISTINCT page_id, url FROM {D.LINKS} WHERE {D.should_crawl('url', 'page_url')}")
def crawlable_links(spark, d):
    return pages.crawl_links(pages.parse_pages(_t(spark, d, "pages"), only=("links", "sidebar_links")), _own()).select(F.col("ord").alias("page_id"), F.explode("followed").alias("url"))


_NAV = f"""(SELECT page_id, slug, arg_max(title, i) AS title, arg_max(url, i) AS url, min(i) AS place FROM (SELECT page_id, i, title, url || coalesce(nullif(regexp_extract(href, '(#[\\s\\S]*)', 1), ''), '') AS url, {D.slug("title")} AS slug FROM {D.LINKS} WHERE length(title) >= 2) GROUP BY page_id, slug)"""


@register("nav_flat", f"SELECT page_id, slug, title, {D.norm_url('url')} AS url FROM {_NAV}")
def nav_flat(spark, d):
    parsed = pages.parse_pages(_t(spark, d, "pages"), only=("nav",))
    return parsed.select(F.col("ord").alias("page_id"), F.explode("nav").alias("n")).select("page_id", "n.slug", "n.title", S.normalize_url(F.col("n.url")).alias("url"))


def _seeded_nav(spark, d) -> DataFrame:
    """Navigation rows made of page URLs: even pages are entries of their domain; every URL twice, with different titles."""
    p = _page_docs(spark, d).where("ord % 2 = 0")
    one = p.select("url", F.concat(F.lit("First "), "title").alias("title"), "subcategory", "domain", "ord")
    two = p.select(F.concat("url", F.lit("#part")).alias("url"), F.concat(F.lit("Second "), "title").alias("title"), "subcategory", "domain", (F.col("ord") + 1_000_000_000).alias("ord"))
    both = one.unionByName(two)
    path = F.array("domain", F.lit("section"), "subcategory")
    return both.select("url", "title", F.col("subcategory").alias("slug"), "domain", F.lit(2).alias("depth"), F.lit(0).alias("order"), F.lit("section").alias("parentSlug"), path.alias("navPath"), F.array("domain", F.lit("Section"), "title").alias("pathTitles"), "ord")


_SEEDED = f"""(SELECT url, 'First ' || title AS title, subcategory AS slug, domain, ord, {D.norm_url("regexp_replace(url, '#.*', '')")} AS norm_url FROM {_PAGES} WHERE ord % 2 = 0
 UNION ALL SELECT url || '#part', 'Second ' || title, subcategory, domain, ord + 1000000000, {D.norm_url("regexp_replace(url, '#.*', '')")} FROM {_PAGES} WHERE ord % 2 = 0)"""


@register("nav_index_last", f"SELECT norm_url, arg_max(title, ord) AS title FROM {_SEEDED} GROUP BY norm_url")
def nav_index_last(spark, d):
    return navigation.url_index(_seeded_nav(spark, d)).select("norm_url", "title")


@register("nav_merge_first", f"SELECT norm_url, arg_min(title, ord) AS title FROM {_SEEDED} GROUP BY norm_url")
def nav_merge_first(spark, d):
    nav = _seeded_nav(spark, d)
    return navigation.merge_flat(nav.where("ord < 1000000000"), nav.where("ord >= 1000000000")).select("norm_url", "title")


@register("crawl_nav_first", f"SELECT regexp_replace(url, '/$', '') AS norm_url, arg_min(title, ord) AS title FROM {_SEEDED} GROUP BY 1")
def crawl_nav_first(spark, d):
    return navigation.crawl_index(_seeded_nav(spark, d)).select("norm_url", "title")


@register("hierarchy_assign", f"WITH p AS {_PAGES}, n AS (SELECT DISTINCT norm_url FROM {_SEEDED}) SELECT ord AS page_id, domain, CASE WHEN n.norm_url IS NOT NULL THEN 'section' ELSE subcategory END AS subcategory FROM p LEFT JOIN n ON {D.norm_url('url')} = n.norm_url")
def hierarchy_assign(spark, d):
    return navigation.assign_hierarchy(_page_docs(spark, d), _seeded_nav(spark, d)).select(F.col("ord").alias("page_id"), "domain", "subcategory")


@register(
    "document_location",
    f"""WITH p AS {_PAGES}, n AS (SELECT norm_url, arg_max(slug, ord) AS slug, arg_max(domain, ord) AS nd, arg_max(title, ord) AS nt FROM {_SEEDED} GROUP BY 1), j AS (SELECT p.*, n.slug, nd, nt, {D.url_slug("url")} AS us FROM p LEFT JOIN n ON {D.norm_url("url")} = n.norm_url)
SELECT ord AS page_id, coalesce(nd, domain) AS domain, CASE WHEN slug IS NULL THEN '' ELSE 'section' END AS segments, coalesce(slug, us) || '.json' AS filename, CASE WHEN slug IS NULL THEN us ELSE 'section' END AS subcategory,
 CASE WHEN slug IS NULL THEN concat_ws('|', nullif(CASE WHEN domain = 'start' THEN 'Start' ELSE {D.capitalised("regexp_replace(domain, '^v1-', '')")} END, ''), nullif(title, '')) ELSE nd || '|Section|' || nt END AS breadcrumbs FROM j""",
)
def document_location(spark, d):
    out = navigation.storage_location(_page_docs(spark, d), _seeded_nav(spark, d), _own())
    return out.select(F.col("ord").alias("page_id"), F.col("loc_domain").alias("domain"), F.array_join("loc_segments", "/").alias("segments"), F.col("loc_filename").alias("filename"), F.col("loc_subcategory").alias("subcategory"), F.array_join("loc_breadcrumbs", "|").alias("breadcrumbs"))


@register("uncrawled_urls", f"SELECT DISTINCT norm_url AS url, {D.url_hash('norm_url')} AS id FROM {_SEEDED} WHERE {D.should_crawl('norm_url', 'url')} AND {D.url_hash('norm_url')} NOT IN (SELECT {D.url_hash(D.norm_url('url'))} FROM pages WHERE page_id % 4 = 0)")
def uncrawled_urls(spark, d):
    crawled = _t(spark, d, "pages").where("page_id % 4 = 0").select(S.url_hash(S.normalize_url(F.col("url"))).alias("id"))
    return navigation.uncrawled(_seeded_nav(spark, d), crawled, _own())


@register("rebuild_counts", f"SELECT count(*) FILTER (page_id % 5 <> 0) AS rebuilt, count(*) FILTER (page_id % 5 = 0) AS missing FROM pages")  # noqa: F541
def rebuild_counts(spark, d):
    p = _page_docs(spark, d)
    return pipeline.rebuild_counts(p.select("id"), p.where("ord % 5 <> 0").select("url")).select("rebuilt", F.col("missingUrl").alias("missing"))


@register("nav_sorted", f"WITH p AS {_PAGES}, r AS (SELECT domain, row_number() OVER (ORDER BY min(ord)) - 1 AS k FROM p WHERE ord % 2 = 0 GROUP BY domain) SELECT ord AS page_id, CAST(coalesce(k, 999) AS INTEGER) AS nav_rank FROM p LEFT JOIN r USING (domain)")
def nav_sorted(spark, d):
    p = _page_docs(spark, d)
    roots = _seeded_nav(spark, d).where("ord < 1000000000").withColumn("depth", F.lit(0))
    return navigation.sort_by_nav(p, roots).select(F.col("ord").alias("page_id"), F.col("nav_rank").cast("int").alias("nav_rank"))


# texts


@register("text_clean", f"SELECT doc_id, {D.ws('text')} AS normalized, {D.plain('text')} AS plain, {D.content_hash('text')} AS content_hash FROM documents")
def text_clean(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", S.normalize_whitespace(t).alias("normalized"), S.plain_text(t).alias("plain"), S.content_hash(t).alias("content_hash"))


@register("token_estimate", f"SELECT doc_id, {D.tokens('text')} AS tokens FROM documents")
def token_estimate(spark, d):
    return _t(spark, d, "documents").select("doc_id", S.estimate_tokens(F.col("text")).alias("tokens"))


@register("slugs", f"SELECT doc_id, {D.slug('text')} AS slug, {D.safe_slug('text')} AS safe, {D.capitalised(D.safe_slug('text'))} AS titled FROM documents")
def slugs(spark, d):
    # of the whole text, made once a row
    made = _t(spark, d, "documents").select("doc_id", S.slugify(F.col("text")).alias("slug"))
    named = made.select("doc_id", "slug", S.safe_of(F.col("slug")).alias("safe"))
    return named.select("doc_id", "slug", "safe", S.humanize_slug(F.col("safe")).alias("titled"))


@register("text_signs", "SELECT doc_id, CASE WHEN length(text) <= 60 THEN text ELSE left(text, 57) || '...' END AS short, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped, regexp_matches(text, '(?i)auth(orization|enticat)|bearer|api[- ]?key|oauth|token required') AS needs_auth FROM documents")
def text_signs(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", S.truncate(t, 60).alias("short"), S.escape_html(t).alias("escaped"), S.requires_auth(t).alias("needs_auth"))


_SECRET = D.chain("text", *[(p.replace("'", "''"), "[REDACTED]") for p in S.SECRETS])


@register("secret_redaction", f"SELECT doc_id, {_SECRET} AS clean FROM documents")
def secret_redaction(spark, d):
    return _t(spark, d, "documents").select("doc_id", S.redact_secrets(F.col("text")).alias("clean"))


@register("content_dedupe", f"SELECT min(doc_id) AS doc_id, {D.content_hash('text')} AS content_hash FROM documents GROUP BY 2")
def content_dedupe(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", S.content_hash(F.col("text")).alias("contentHash"))
    return corpus.dedupe_content(docs, "doc_id").select("doc_id", F.col("contentHash").alias("content_hash"))


# chunks


def _text_docs(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("domain"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.concat(F.lit("https://docs.example/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"), F.lit("concept").alias("type"), F.col("text").alias("markdown"))


_CHUNK = f"""SELECT {D.content_hash("doc || '-' || named || '-' || left(c, 50)")} AS id, domain, section, type, hint AS embedding_hint, c AS content, kind AS chunk_type, url AS source_url, doc AS document_id, k - 1 AS ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY doc ORDER BY i) AS k FROM (SELECT *, min(i) OVER (PARTITION BY doc, md5(c)) AS first FROM (SELECT *, {D.ws("raw")} AS c FROM pieces)) WHERE i = first AND length(c) >= 30)"""
_SIZED = f"""WITH pieces AS (SELECT CAST(doc_id AS VARCHAR) AS doc, source AS domain, 'concept' AS type, 'section-0' AS section, 'section-0' AS named, 'content' AS kind, source || ' Document ' || doc_id AS hint, 'https://docs.example/' || source || '/' || doc_id AS url, 0 AS i, {D.plain("text")} AS raw
  FROM documents WHERE length({D.plain("text")}) > 20) {_CHUNK}"""


def _flat(c: DataFrame) -> DataFrame:
    return c.select("id", "domain", "section", "type", "embedding_hint", "content", F.col("metadata")["chunkType"].alias("chunk_type"), F.col("sourceUrl").alias("source_url"), F.col("documentId").alias("document_id"), F.col("ordinal").cast("long").alias("ordinal"))


@register("chunk_by_size", _SIZED)
def chunk_by_size(spark, d):
    return _flat(chunks.chunk_by_size(_text_docs(spark, d)))


def _chats(spark, d) -> DataFrame:
    """Each conversation as markdown, a heading a turn."""
    turns = _t(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("## "), "role", F.lit(" "), F.col("turn").cast("string"), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("part"))
    md = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "part"))), lambda x: x["part"]), "\n").alias("markdown"))
    i = F.col("conv_id").cast("string")
    return md.select(i.alias("id"), F.lit("chat").alias("domain"), F.concat(F.lit("Conversation "), i).alias("title"), F.concat(F.lit("https://chat.example/"), i).alias("url"), F.lit("guide").alias("type"), "markdown")


_SECTIONED = f"""WITH turns AS (SELECT CAST(conv_id AS VARCHAR) AS doc, turn, '## ' || role || ' ' || turn || chr(10) || coalesce(text, '') AS raw, {D.slug("role || ' ' || turn")} AS s FROM conversations),
cut AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY turn) AS i, raw, s, {D.tokens("raw")} > 512 AS over FROM turns),
pieces AS (SELECT doc, 'chat' AS domain, 'guide' AS type, CASE WHEN over THEN s || '-section-0' ELSE s END AS section, CASE WHEN over THEN 'section-0' ELSE s END AS named, CASE WHEN over THEN 'content' ELSE 'section' END AS kind,
  'chat Conversation ' || doc AS hint, 'https://chat.example/' || doc AS url, i, CASE WHEN over THEN {D.plain("raw")} ELSE raw END AS raw FROM cut) {_CHUNK}"""


@register("chunk_sections", _SECTIONED)
def chunk_sections(spark, d):
    return _flat(chunks.chunk_sections(_chats(spark, d)))


def _packed(text):
    """Greedily packed paragraphs of a text, a line each; chr(1) stands between the pieces."""
    paragraphs = f"list_filter(list_transform(regexp_split_to_array({text}, '\\n+'), lambda p: {D.plain('p')}), lambda p: length(p) > 20)"
    grown = "(regexp_extract(acc, '[^' || chr(1) || ']*$') || chr(10) || chr(10) || p)"
    step = f"CASE WHEN {D.tokens(grown)} > 512 THEN acc || chr(1) || p ELSE acc || chr(10) || chr(10) || p END"
    return f"CASE WHEN len({paragraphs}) = 0 THEN [] ELSE string_split(list_reduce({paragraphs}, lambda acc, p: {step}), chr(1)) END"


_PARAGRAPHS = f"""WITH packed AS (SELECT doc_id, source, {_packed("text")} AS cs FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT CAST(doc_id AS VARCHAR) AS doc, source AS domain, 'concept' AS type, 'section-' || (i - 1) AS section, 'section-' || (i - 1) AS named, 'content' AS kind, source || ' Document ' || doc_id AS hint, 'https://docs.example/' || source || '/' || doc_id AS url, i, raw
  FROM (SELECT doc_id, source, unnest(cs) AS raw, generate_subscripts(cs, 1) AS i FROM packed)) {_CHUNK}"""


@register("chunk_paragraphs", _PARAGRAPHS)
def chunk_paragraphs(spark, d):
    return _flat(chunks.chunk_by_size(_text_docs(spark, d).withColumn("markdown", F.regexp_replace("markdown", "\n", "\n\n")), paragraph_aware=True))


_PAGE_CHUNKS = f"""WITH cut AS (SELECT *, {D.slug("regexp_extract(markdown, '^# ([^\\n]+)', 1)")} AS s, {D.tokens("markdown")} > 512 AS over FROM {D.DOCUMENTS}),
pieces AS (SELECT {D.url_hash("url")} AS doc, domain, type, CASE WHEN over THEN s || '-section-0' ELSE s END AS section, CASE WHEN over THEN 'section-0' ELSE s END AS named, CASE WHEN over THEN 'content' ELSE 'section' END AS kind,
  domain || ' ' || title AS hint, url, 0 AS i, CASE WHEN over THEN {D.plain("markdown")} ELSE markdown END AS raw FROM cut) {_CHUNK}"""


@register("chunk_pages", _PAGE_CHUNKS)
def chunk_pages(spark, d):
    return _flat(chunks.chunk_documents(pipeline.rebuild(_t(spark, d, "pages"))))


@register("rag_generic", f"SELECT id, content AS document, section, chunk_type, embedding_hint, source_url, document_id FROM ({_SIZED})")
def rag_generic(spark, d):
    lines = writers.generic_records(chunks.chunk_by_size(_text_docs(spark, d)))
    r = F.from_json("value", "id string, document string, metadata map<string,string>, embedding_hint string")
    return lines.select(r.alias("r")).select("r.id", "r.document", F.col("r.metadata")["section"].alias("section"), F.col("r.metadata")["chunkType"].alias("chunk_type"), "r.embedding_hint", F.col("r.metadata")["source_url"].alias("source_url"), F.col("r.metadata")["document_id"].alias("document_id"))


@register("rag_qdrant", f"SELECT id, content, domain, section, source_url AS url, document_id, embedding_hint || chr(10) || chr(10) || content AS embedding_text FROM ({_SECTIONED})")
def rag_qdrant(spark, d):
    p = writers.qdrant_points(chunks.chunk_sections(_chats(spark, d)))
    g = lambda k: F.col("payload")[k]
    return p.select("id", g("content").alias("content"), g("domain").alias("domain"), g("section").alias("section"), g("url").alias("url"), g("document_id").alias("document_id"), writers.embedding_text(g("embedding_hint"), g("content")).alias("embedding_text"))


@register("rag_chroma", f"SELECT id, content AS document, embedding_hint FROM ({_SIZED})")
def rag_chroma(spark, d):
    b = writers.chroma_batches(chunks.chunk_by_size(_text_docs(spark, d)))
    return b.select(F.explode(F.arrays_zip("ids", "documents", "embedding_hints")).alias("x")).select(F.col("x.ids").alias("id"), F.col("x.documents").alias("document"), F.col("x.embedding_hints").alias("embedding_hint"))


@register("rag_documents_summary", f"SELECT CAST(doc_id AS VARCHAR) AS id, left({D.plain('text')}, 200) AS preview, source || ': Document ' || doc_id || ' - ' AS embedding_text FROM documents")
def rag_documents_summary(spark, d):
    return writers.documents_summary(_text_docs(spark, d).withColumn("description", F.lit(None).cast("string"))).select("id", "preview", "embedding_text")


# quality and audit

_TITLED = """(SELECT *, CASE doc_id % 7 WHEN 0 THEN 'Loading' WHEN 1 THEN '200 OK' WHEN 2 THEN ' page ' ELSE substring(text, 1, 30) END AS title, CASE WHEN doc_id % 11 = 0 THEN concat(text, ' Retrieving recent requests') WHEN doc_id % 13 = 0 THEN 'Loading...' ELSE text END AS content FROM documents)"""


def _graded(spark, d) -> DataFrame:
    t = _t(spark, d, "documents")
    t.createOrReplaceTempView("documents")
    docs = spark.sql(f"SELECT * FROM {_TITLED}")
    none = F.lit(None).cast("string")
    docs = docs.withColumn("issues", rules.quality_issues(F.col("title"), F.col("content"), F.col("content"), F.lit("concept"), F.lit(None).cast("struct<method:string,bodyParams:array<struct<name:string,description:string>>,responses:array<string>,response:string,examples:array<string>>"), F.lit(None).cast("array<string>"), F.lit(None).cast("array<string>")))
    return docs.withColumn("quality", rules.extraction_quality(F.col("issues"))).withColumn("url", F.when(F.col("doc_id") % 17 == 0, none).otherwise(F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string"))))


_GRADED = f"""(SELECT *, list_filter([CASE WHEN {D.title_bad("title")} THEN 'bad_title' END, CASE WHEN {D.placeholder("content")} THEN 'placeholders' END], lambda x: x IS NOT NULL) AS issues FROM {_TITLED})"""
_QUALITY = f"(SELECT *, CASE len(issues) WHEN 0 THEN 'complete' WHEN 2 THEN 'failed' ELSE 'partial' END AS quality, doc_id % 17 <> 0 AS valid FROM {_GRADED})"


@register("quality_issues", f"SELECT doc_id, array_to_string(issues, ',') AS issues, quality FROM {_QUALITY}")
def quality_issues(spark, d):
    return _graded(spark, d).select("doc_id", F.array_join("issues", ",").alias("issues"), "quality")


@register(
    "quality_score",
    f"""SELECT doc_id, score, CASE WHEN score >= 92 THEN CASE WHEN v THEN 'good' ELSE 'excellent' END WHEN score >= 78 THEN 'good' WHEN score >= 55 THEN 'partial' WHEN score >= 30 THEN 'poor' ELSE 'broken' END AS grade FROM (
 SELECT doc_id, doc_id % 5 = 0 AS v, CAST((CASE WHEN {D.trim("title")} <> '' AND doc_id % 3 > 0 THEN 40 ELSE 0 END) + (CASE WHEN doc_id % 3 > 0 THEN 20 ELSE 0 END) + (CASE WHEN doc_id % 2 = 0 THEN 20 ELSE 0 END) + (CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 20 END) AS INTEGER) AS score FROM {_TITLED})""",
)
def quality_score(spark, d):
    docs = _graded(spark, d)
    crumbs = F.slice(F.array(F.lit("a"), F.lit("b")), 1, (F.col("doc_id") % 3).cast("int"))
    endpoint = F.lit(None).cast("struct<method:string,path:string,summary:string,bodyParams:array<string>,headers:array<string>,responses:array<string>,examples:array<string>>")
    q = rules.quality_score(F.lit("concept"), endpoint, F.col("title"), F.lit(None).cast("array<string>"), crumbs, F.col("doc_id") % 2 == 0, F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("x"))))
    return docs.select("doc_id", q.alias("q")).select("doc_id", "q.score", "q.grade")


def _audited(spark, d) -> DataFrame:
    g = _graded(spark, d)
    return g.select(F.col("doc_id"), F.col("source").alias("domain"), S.is_url(F.col("url")).alias("valid"), "quality", corpus.audit_issues(F.col("title"), F.col("content")).alias("issues"), "url")


_AUDITED = f"""(SELECT doc_id, source AS domain, valid, quality, list_filter([CASE WHEN regexp_matches({D.trim("title")}, '(?i)^(200\\s*ok?|200|loading|untitled)$') THEN 'bad_title' END, CASE WHEN regexp_matches(content, '(?i)retrieving recent requests|loadingloading') THEN 'placeholders' END], lambda x: x IS NOT NULL) AS issues FROM {_QUALITY})"""
_COUNTS = f"""(WITH a AS {_AUDITED} SELECT 'total' AS dimension, 'totalFiles' AS key, count(*) AS n FROM a UNION ALL SELECT 'total', 'validDocuments', count(*) FROM a WHERE valid UNION ALL SELECT 'domain', domain, count(*) FROM a GROUP BY domain
 UNION ALL SELECT 'quality', quality, count(*) FROM a WHERE valid GROUP BY quality UNION ALL SELECT 'issue', i, count(*) FROM (SELECT unnest(issues) AS i FROM a WHERE valid) GROUP BY i)"""


@register("audit_report", f"SELECT * FROM {_COUNTS}")
def audit_report(spark, d):
    return corpus.audit_counts(_audited(spark, d))


@register("audit_samples", f"SELECT doc_id, array_to_string(issues, ',') AS issues FROM {_AUDITED} WHERE valid AND len(issues) > 0 ORDER BY doc_id LIMIT 30")
def audit_samples(spark, d):
    return corpus.audit_samples(_audited(spark, d), "doc_id").select("doc_id", F.array_join("issues", ",").alias("issues"))


@register(
    "audit_thresholds",
    f"""SELECT p <= 0.5 AND f <= 0.1 AS ok, concat_ws('; ', CASE WHEN p > 0.5 THEN 'partial+failed ' || printf('%.1f', p * 100) || '% > 50%' END, CASE WHEN f > 0.1 THEN 'failed ' || printf('%.1f', f * 100) || '% > 10%' END) AS reasons FROM (
 SELECT (sum(n) FILTER (dimension = 'quality' AND key IN ('partial', 'failed')))::DOUBLE / max(n) FILTER (key = 'validDocuments') AS p, coalesce((sum(n) FILTER (dimension = 'quality' AND key = 'failed'))::DOUBLE, 0) / max(n) FILTER (key = 'validDocuments') AS f FROM {_COUNTS})""",
)
def audit_thresholds(spark, d):
    return corpus.audit_thresholds(corpus.audit_counts(_audited(spark, d)), 0.5, 0.1).select("ok", "reasons")


@register("placeholders", f"SELECT doc_id, {D.is_placeholder('title')} AS title_loading, {D.placeholder('content')} AS content_loading, CASE WHEN NOT {D.is_placeholder('title')} THEN {D.trim('title')} END AS clean FROM {_TITLED}")
def placeholders(spark, d):
    return _graded(spark, d).select("doc_id", S.is_placeholder(F.col("title")).alias("title_loading"), S.has_placeholder(F.col("content")).alias("content_loading"), S.sanitize_text(F.col("title")).alias("clean"))


# domain graph

_WORDS = "CASE lang WHEN 'en' THEN 'the-of' WHEN 'fr' THEN 'les' WHEN 'de' THEN 'und' ELSE 'que' END"


def _graph_docs(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("ord"), F.expr(_WORDS).alias("domain"), F.substring("text", 1, 20).alias("title"), F.col("text").alias("content"), (F.col("doc_id") % 9 == 0).alias("authRequired"), F.when(F.col("doc_id") % 50 == 0, F.struct(F.lit("GET").alias("method"), F.concat(F.lit("/d/"), F.col("doc_id").cast("string")).alias("path"), F.lit(False).alias("authRequired"))).alias("endpoint"))


_GRAPH = f"(SELECT doc_id AS ord, {_WORDS} AS domain, left(text, 20) AS title, text AS content, doc_id % 9 = 0 AS auth FROM documents)"
_RELATED = f"(SELECT DISTINCT g.domain, o.domain AS related, o.f FROM {_GRAPH} g JOIN (SELECT domain, min(ord) AS f FROM {_GRAPH} GROUP BY domain) o ON o.domain <> g.domain AND contains(lower(g.content), replace(o.domain, '-', ' ')))"


@register("related_domains", f"SELECT domain, related FROM {_RELATED}")
def related_domains(spark, d):
    return corpus.related_domains(_graph_docs(spark, d), "ord").select("domain", "related")


@register(
    "architecture_map",
    f"""SELECT domain, {D.capitalised("domain")} AS title, coalesce((SELECT string_agg(related, ',' ORDER BY f) FROM {_RELATED} r WHERE r.domain = g.domain), '') AS related_domains, bool_or(auth) AS requires_auth, '' AS depends_on,
 coalesce(string_agg('GET /d/' || ord, ',' ORDER BY ord) FILTER (ord % 50 = 0), '') AS endpoints, string_agg({D.slug("title")}, ',' ORDER BY ord) AS pages FROM {_GRAPH} g GROUP BY domain""",
)
def architecture_map(spark, d):
    out = corpus.architecture_map(_graph_docs(spark, d), "ord")
    joined = lambda c: F.array_join(c, ",").alias(c)
    return out.select("domain", "title", joined("related_domains"), "requires_auth", joined("depends_on"), joined("endpoints"), joined("pages"))


@register(
    "architecture_edges",
    f"""SELECT domain, 'endpoint' AS kind, ord AS position, 'GET /d/' || ord AS value FROM {_GRAPH} UNION ALL SELECT domain, 'page', ord, {D.slug("content")} FROM {_GRAPH} UNION ALL SELECT domain, 'related', f, related FROM {_RELATED}""",
)
def architecture_edges(spark, d):
    """The domain graph of all documents as rows: an endpoint of each, and its title uncut."""
    endpoint = F.struct(F.lit("GET").alias("method"), F.concat(F.lit("/d/"), F.col("ord").cast("string")).alias("path"), F.lit(False).alias("authRequired"))
    docs = _graph_docs(spark, d).withColumns({"title": F.col("content"), "endpoint": endpoint})
    return corpus.architecture_edges(docs, "ord").select("domain", "kind", "position", "value")


# fixed cases

_PATHS = "(SELECT * FROM (VALUES ('/persons/{personId}/documents/{docId}/{personId}'), ('/x/{pageOffset}/{item_uuid}'), ('/plain'), ('/a/{limit}/{name}')) AS t(path))"


@register(
    "path_params",
    f"""SELECT path, i - 1 AS position, name, CASE WHEN contains(lower(name), 'uuid') OR ends_with(lower(name), 'id') THEN 'string' WHEN regexp_matches(lower(name), 'count|offset|limit|page') THEN 'integer' END AS type FROM (
 SELECT path, name, row_number() OVER (PARTITION BY path ORDER BY min(j)) AS i FROM (SELECT path, unnest(n) AS name, generate_subscripts(n, 1) AS j FROM (SELECT path, regexp_extract_all(path, '\\{{([\\w.-]+)\\}}', 1) AS n FROM {_PATHS})) GROUP BY path, name)""",
)
def path_params(spark, d):
    rows = spark.sql(f"SELECT * FROM {_PATHS}").select("path", F.posexplode(S.path_params(F.col("path"))).alias("position", "p"))
    return rows.select("path", F.col("position").cast("long").alias("position"), "p.name", "p.type")


@register("param_fingerprints", "SELECT doc_id, left(sha256('query|' || lower(trim(regexp_replace(left(text, 12), '\\s+', ' ', 'g'))) || '|string|' || left(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 200)), 20) AS fp, left(sha256('snippet|' || lang || '||' || left(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 400)), 20) AS code_fp, left(sha256('200|' || left(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 240)), 16) AS response_fp FROM documents")
def param_fingerprints(spark, d):
    none = F.lit(None).cast("string")
    p = F.struct(F.lit("query").alias("in"), F.substring("text", 1, 12).alias("name"), F.lit("string").alias("type"), F.col("text").alias("description"))
    c = F.struct(none.alias("exampleType"), F.col("lang").alias("language"), none.alias("label"), F.col("text").alias("code"))
    r = F.struct(F.lit("200").alias("statusCode"), F.col("text").alias("description"))
    return _t(spark, d, "documents").select("doc_id", p.alias("p"), c.alias("c"), r.alias("r")).select("doc_id", S.fingerprint_param(F.col("p")).alias("fp"), S.fingerprint_code(F.col("c")).alias("code_fp"), S.fingerprint_response(F.col("r")).alias("response_fp"))


_SPECS = """(SELECT * FROM (VALUES (1, '{"openapi":"3.0.0","paths":{"/a":{"get":{"summary":"List"},"post":{}},"/b/{id}":{"delete":{"summary":"Drop"},"x-note":{"summary":"no"}}}}'), (2, '{"paths":{}}'), (3, 'not json')) AS t(spec_id, body))"""


@register(
    "openapi_endpoints",
    f"""WITH s AS (SELECT spec_id, CASE WHEN json_valid(body) THEN body::JSON END AS j FROM {_SPECS}), p AS (SELECT spec_id, unnest(map_entries(CAST(json_extract(j, '$.paths') AS MAP(VARCHAR, JSON)))) AS e FROM s WHERE j IS NOT NULL),
 m AS (SELECT spec_id, e.key AS path, unnest(map_entries(CAST(e.value AS MAP(VARCHAR, JSON)))) AS i FROM p) SELECT spec_id, upper(i.key) AS method, path, json_extract_string(i.value, '$.summary') AS summary FROM m WHERE i.key IN ('get', 'post', 'put', 'patch', 'delete', 'head', 'options')""",
)
def openapi_endpoints(spark, d):
    return api.openapi_endpoints(spark.sql(f"SELECT * FROM {_SPECS}"))


_OPS = "(SELECT * FROM (VALUES (1, 'query GetUser { user { id } } mutation Save($x: Int) { save }'), (2, '{ user { id } }'), (3, '  '), (4, 'subscription { s }')) AS t(op_id, query))"


@register(
    "graphql_ops",
    f"""WITH q AS (SELECT op_id, query, regexp_extract_all(query, '(?i)\\b(query|mutation|subscription)\\s+(\\w+)?[^{{]*\\{{', 1) AS k, regexp_extract_all(query, '(?i)\\b(query|mutation|subscription)\\s+(\\w+)?[^{{]*\\{{', 2) AS n FROM {_OPS})
SELECT op_id, lower(unnest(k)) AS type, nullif(unnest(n), '') AS name FROM q WHERE len(k) > 0 UNION ALL SELECT op_id, 'unknown', NULL FROM q WHERE len(k) = 0 AND trim(query) <> ''""",
)
def graphql_ops(spark, d):
    return api.graphql_operations(spark.sql(f"SELECT * FROM {_OPS}")).select("op_id", "type", "name")


_CASES = "(SELECT * FROM (VALUES (1, '{\"a\": 1}'), (2, '<a/>'), (3, 'curl -X GET x'), (4, 'GET /users'), (5, 'const x = 1'), (6, 'def f():'), (7, 'plain words')) AS t(case_id, code))"


@register("code_languages", f"SELECT case_id, CASE WHEN regexp_matches(code, '^[{{\\[]') THEN 'json' WHEN starts_with(code, '<') THEN 'xml' WHEN regexp_matches(code, '(?i)^(curl|wget)\\s') THEN 'bash' WHEN regexp_matches(code, '(?m)^(GET|POST|PUT|PATCH|DELETE)\\s+/') THEN 'http' WHEN regexp_matches(code, '(?m)^(import|export|const|let|function|class)\\s') THEN 'typescript' WHEN regexp_matches(code, '(?m)^def\\s') THEN 'python' ELSE 'text' END AS language FROM {_CASES}")
def code_languages(spark, d):
    return spark.sql(f"SELECT * FROM {_CASES}").select("case_id", S.code_language(F.col("code")).alias("language"))


_EDGES = "(SELECT * FROM (VALUES ('a', 'b'), ('b', 'c'), ('c', 'a'), ('b', 'd'), ('x', 'y'), ('d', 'e')) AS t(src, dst))"


@register("frontier_bfs", f"WITH RECURSIVE e AS {_EDGES}, r(url, depth) AS (SELECT 'a', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < 6) SELECT url, min(depth)::INTEGER AS depth FROM r GROUP BY url")
def frontier_bfs(spark, d):
    return frontier.reachable(spark.sql(f"SELECT * FROM {_EDGES}"), spark.sql("SELECT 'a' AS url"), checkpoint=_cut)


def _cut(df, name):
    """A checkpoint, local where the session has no folder for them."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


# every page is a seed, so only the literal graph is deeper than 1
@register("frontier_links", f"WITH RECURSIVE e AS (SELECT page_url AS src, url AS dst FROM {D.LINKS} UNION SELECT * FROM {_EDGES}), r(url, depth) AS (SELECT url, 0 FROM (SELECT url FROM pages UNION SELECT 'a') UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < 6) SELECT url, min(depth)::INTEGER AS depth FROM r GROUP BY url")
def frontier_links(spark, d):
    """Breadth-first over the links of all pages and the literal graph."""
    links = pages.parse_pages(_t(spark, d, "pages"), only=("links",)).select(F.col("url").alias("src"), F.explode("links").alias("dst"))
    links = _cut(links.distinct().unionByName(spark.sql(f"SELECT * FROM {_EDGES}")), "links")
    return frontier.reachable(links, _t(spark, d, "pages").select("url").unionByName(spark.sql("SELECT 'a' AS url")), checkpoint=_cut)


@register("frontier_enqueue", f"WITH p AS (SELECT {D.norm_url('url')} AS url, min(page_id) AS seq FROM pages GROUP BY 1) SELECT CASE WHEN seq % 3 = 0 THEN 'visited' ELSE 'pending' END AS state, count(*) AS n FROM p GROUP BY 1")
def frontier_enqueue(spark, d):
    p = _t(spark, d, "pages").select("url", F.col("page_id").alias("seq"))
    state = frontier.enqueue(frontier.empty(spark), p)
    done = state.where("seq % 3 = 0").select("url", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason"))
    return frontier.snapshot(frontier.enqueue(frontier.mark(state, done), p))


@register("tables_markdown", "SELECT * FROM (VALUES (1::INTEGER, '**C**' || chr(10) || chr(10) || '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 |  |' || chr(10) || '| 2 | 3 |'), (2::INTEGER, '| h |' || chr(10) || '| --- |' || chr(10) || '| v |')) AS t(k, markdown)")
def tables_markdown(spark, d):
    rows = spark.createDataFrame([(1, [(["a", "b"], [["1"], ["2", "3", "4"]], "C")]), (2, [([], [["h"], ["v"]], None)])], "k int, t array<struct<headers:array<string>,rows:array<array<string>>,caption:string>>")
    return rows.select("k", S.tables_markdown(F.col("t")).alias("markdown"))


@register("nav_supplement", f"WITH n AS (SELECT DISTINCT norm_url FROM {_SEEDED}), p AS (SELECT {D.norm_url('url')} AS norm_url, min(ord) AS ord FROM {_PAGES} GROUP BY 1) SELECT norm_url AS url, {D.url_slug('norm_url')} AS slug, {D.url_domain('norm_url')} AS domain FROM p WHERE norm_url NOT IN (SELECT norm_url FROM n)")
def nav_supplement(spark, d):
    nav = _seeded_nav(spark, d)
    links = _page_docs(spark, d).select("url", "title", "ord")
    return navigation.supplement(nav, links, _own("norm_url")).where("depth = 0").select("url", "slug", "domain")


@register("health", f"SELECT count(*) AS html, count(*) FILTER (ord % 5 > 0) AS json, count(*) FILTER (ord % 5 = 0) AS unparsed FROM {_PAGES}")
def health(spark, d):
    p = _page_docs(spark, d)
    return corpus.health(p.select("id"), p.where("ord % 5 > 0").select("id"))


@register("domain_slugs", "SELECT * FROM (VALUES ('start', 0::INTEGER), ('cards', 2::INTEGER), ('v1-cards', 3::INTEGER), ('v1-new', 999::INTEGER)) AS t(slug, rank)")
def domain_slugs(spark, d):
    urls = spark.sql("SELECT * FROM (VALUES ('https://h/cards/x'), ('https://h/start'), ('https://h/v1-cards/reference/a'), ('https://h/v1-new/b'), ('https://h/other/c'), ('https://h/cards/z')) AS t(url)")
    return navigation.domain_slugs(urls, F.lit("https://h"), ("start", "loans", "cards"), ("start", "loans", "cards", "v1-cards"))


@register("tree_merge", "SELECT * FROM (VALUES ('a', 'A', 'https://h/a'), ('a/b', 'B', 'https://h/b'), ('a/c', 'C', NULL), ('d', 'D', 'https://h/d')) AS t(path, title, url)")
def tree_merge(spark, d):
    one = spark.sql("SELECT split(p, '/') AS path, title, url, 0 AS depth, 0 AS `order` FROM (VALUES ('a', 'A', NULL), ('a/b', '', 'https://h/b'), ('a/c', 'C', NULL)) AS t(p, title, url)")
    two = spark.sql("SELECT split(p, '/') AS path, title, url, 0 AS depth, 1 AS `order` FROM (VALUES ('a', 'Other', 'https://h/a'), ('a/b', 'B', 'https://h/no'), ('d', 'D', 'https://h/d')) AS t(p, title, url)")
    return navigation.merge_tree(one, two).select(F.array_join("path", "/").alias("path"), "title", "url")


@register("frontmatter", "SELECT doc_id, '---' || chr(10) || 'domain: \"' || source || '\"' || chr(10) || 'subcategory: \"' || lang || '\"' || chr(10) || 'title: \"Document ' || doc_id || '\"' || chr(10) || 'type: \"concept\"' || chr(10) || 'tags:' || chr(10) || '  - ' || source || chr(10) || '  - concept' || chr(10) || 'id: \"' || doc_id || '\"' || chr(10) || '---' || chr(10) AS head, source AS parsed_domain FROM documents")
def frontmatter(spark, d):
    i = F.col("doc_id").cast("string")
    fields = {"domain": F.col("source"), "subcategory": F.col("lang"), "title": F.concat(F.lit("Document "), i), "type": F.lit("concept"), "method": F.lit(None).cast("string"), "id": i}
    head = S.frontmatter(fields, F.lit(None).cast("boolean"), F.array("source", F.lit("concept")))
    return _t(spark, d, "documents").select("doc_id", head.alias("head")).select("doc_id", "head", S.frontmatter_field(F.col("head"), "domain").alias("parsed_domain"))


@register("stored_documents", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) WHEN doc_id % 4 = 1 THEN left(md5(CAST(doc_id AS VARCHAR)), 12) WHEN doc_id % 4 = 2 THEN left(sha256(text), 16) ELSE 'unknown' END AS id FROM documents")
def stored_documents(spark, d):
    m, i = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    name = F.when(m == 1, F.concat(F.lit("page-"), S.url_hash(i), F.lit(".json"))).otherwise("page.json")
    return _t(spark, d, "documents").select("doc_id", rules.stored_id(F.when(m == 0, i), name, F.when(m != 3, S.content_hash(F.col("text")))).alias("id"))


def _stored_pages(spark, d) -> DataFrame:
    """Stored documents: every third at the path its URL alone gives, every tenth stored twice."""
    none, no_path = F.lit(None).cast("string"), F.expr("cast(array() as array<string>)")
    p = _page_docs(spark, d).withColumn("endpoint", F.lit(None).cast("struct<method:string,path:string>"))
    p = p.unionByName(p.where("ord % 10 = 0").withColumn("ord", F.col("ord") + 1_000_000_000))
    name = S.document_filename(F.col("url"), F.col("title"), _own(), none, none, F.col("id"))
    at = S.json_path(F.col("domain"), F.regexp_replace(name, r"\.md\z", ".json"), no_path)
    return p.withColumn("old_path", F.when(F.col("ord") % 3 == 0, at).otherwise(F.concat(F.lit("json/"), "domain", F.lit("/"), "id", F.lit(".json"))))


_RELOCATED = f"""(WITH q AS {_PAGES}, p AS (SELECT * FROM q UNION ALL SELECT * REPLACE (ord + 1000000000 AS ord) FROM q WHERE ord % 10 = 0),
n AS (SELECT norm_url, arg_max(domain, ord) AS nd FROM {_SEEDED} GROUP BY 1),
s AS (SELECT p.*, nd, {D.url_slug("url")} AS us, {D.safe_slug("title", 40)} AS ts FROM p LEFT JOIN n ON {D.norm_url("url")} = n.norm_url),
f AS (SELECT *, coalesce(CASE WHEN us NOT IN ('', 'index', 'page', 'inicio') THEN us END, CASE WHEN ts NOT IN ('', 'untitled', 'page', '200') THEN ts END, id) || '-' || id AS base FROM s),
g AS (SELECT *, CASE WHEN length(base) <= 100 THEN base ELSE id || '-' || id END AS name FROM f),
h AS (SELECT *, {D.safe_slug("name", 120)} || '.json' AS file FROM g),
k AS (SELECT id, ord, CASE WHEN ord % 3 = 0 THEN 'json/' || {D.safe_slug("domain", 80)} || '/' || file ELSE 'json/' || domain || '/' || id || '.json' END AS old_path,
  'json/' || {D.safe_slug("coalesce(nd, domain)", 80)} || (CASE WHEN nd IS NULL THEN '' ELSE '/section' END) || '/' || file AS new_path FROM h)
SELECT id, old_path, new_path, CASE WHEN ord > min(ord) OVER (PARTITION BY new_path) THEN 'skip' WHEN old_path = new_path THEN 'unchanged' ELSE 'move' END AS action FROM k)"""


@register("relocation_plan", f"SELECT * FROM {_RELOCATED}")
def relocation_plan(spark, d):
    return pipeline.relocation_plan(_stored_pages(spark, d), _seeded_nav(spark, d), _own(), "ord")


@register("relocation_counts", f"SELECT count(*) FILTER (action = 'move') AS moved, count(*) FILTER (action = 'unchanged') AS unchanged, count(*) FILTER (action = 'skip') AS skipped FROM {_RELOCATED}")
def relocation_counts(spark, d):
    return pipeline.relocation_counts(relocation_plan(spark, d))


_HTML = (
    "<html><head><title>Create user</title></head><body><aside><nav><ul><li><a href='/g'>Guide</a><ul><li><a href='/g/a'>Alpha</a></li><li><a href='/g/b'>Beta page</a></li></ul></li><li><a href='/r'>Reference</a></li></ul></nav></aside>"
    "<main><h1>Create user</h1><span class='http-verb'>POST</span> <code>/users/{id}</code><p>Makes a user. Needs a Bearer token.</p><h2>Body params</h2><table><caption>Fields</caption><thead><tr><th>Name</th><th>Type</th><th>Required</th><th>Description</th></tr></thead>"
    "<tbody><tr><td>name</td><td>string</td><td>yes</td><td>Full name</td></tr><tr><td></td><td></td><td></td><td></td></tr></tbody></table><h2>Responses</h2><table><tbody><tr><td>200</td><td>OK</td></tr></tbody></table>"
    "<h3>Example</h3><pre><code class='language-bash'>curl --request POST --url https://h/users</code></pre><h3>User object</h3><pre>{\"type\": \"object\", \"properties\": {\"id\": {\"type\": \"string\"}}, \"required\": [\"id\"]}</pre></main></body></html>"
)


@register("seen_keys", f"SELECT DISTINCT \"contentHash\" AS content_hash, {D.norm_url('url')} AS url FROM {_PAGES}")
def seen_keys(spark, d):
    return readers.seen_keys(_page_docs(spark, d)).select(F.col("contentHash").alias("content_hash"), "url")
