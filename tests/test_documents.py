"""Document operators on small tables."""

import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import rules
from docloom.functions import scalars as S
from docloom.operators import api, chunks, corpus, frontier, navigation, pages
from docloom.plans import pipeline, queries
from docloom.plans.queries import _HTML
from docloom.sources import readers, writers
from docloom.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_path_params_keep_order_and_dedupe(spark):
    got = one(spark, S.path_params(F.lit("/persons/{personId}/documents/{docId}/{personId}")))
    assert [p.name for p in got] == ["personId", "docId"] and got[0].required and got[0]["in"] == "path"


def test_path_param_types(spark):
    assert one(spark, S.path_param_type(F.lit("accountId"))) == "string" and one(spark, S.path_param_type(F.lit("pageOffset"))) == "integer"


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Ex.com:443/a/#x", "https://ex.com/a"), ("http://e.com", "http://e.com"), ("http://e.com/für b", "http://e.com/f%C3%BCr%20b"), ("nope/", "nope"), (None, None),
    ],
)
def test_normalize_url(spark, url, want):
    assert one(spark, S.normalize_url(F.lit(url).cast("string"))) == want


@pytest.mark.parametrize(("text", "want"), [("Ação & Café_x--y", "acao-cafe-x-y"), ("  ", ""), ("-a-", "a")])
def test_slugify(spark, text, want):
    assert one(spark, S.slugify(F.lit(text))) == want


def test_slugs_of_whole_texts(spark, tmp_path):
    long = "Ação número_2 -- the, rest & more: " * 40
    texts = [None, "", "short one", "x" * 89 + " y", "?!" * 60 + "Late words", long, long + "tail", ("é" * 50 + "  ") * 200 + "Ende"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.slugs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        s = "".join(c for c in unicodedata.normalize("NFD", t or "") if not "\u0300" <= c <= "\u036f").lower().strip()
        s = re.sub(r"^-|-$", "", re.sub("-+", "-", re.sub(r"[\s_]+", "-", re.sub(r"[^A-Za-z0-9_\s-]", "", s))))
        safe = (s if len(s) <= 60 else s[:60].rstrip("-")) or "page"
        assert (got[i].slug or "", got[i].safe) == (s, safe), t
        assert got[i].titled == " ".join(w[:1].upper() + w[1:] for w in safe.split("-"))


def test_titles(spark):
    clean = lambda t: one(spark, S.clean_sidebar_title(F.lit(t)))
    assert clean("Create userpost") == "Create user" and clean("get") == "get" and clean("List") == "List"


def test_frontmatter_round_trip(spark):
    head = S.frontmatter({"domain": F.lit('a "b"'), "title": F.lit("t"), "method": F.lit(None).cast("string")}, F.lit(True), F.array(F.lit("x"), F.lit("y")))
    text = one(spark, F.concat(head, F.lit("body")))
    assert text == '---\ndomain: "a \\"b\\""\ntitle: "t"\nauth_required: true\ntags:\n  - x\n  - y\n---\nbody'
    assert one(spark, S.frontmatter_tags(F.lit(text))) == ["x", "y"] and one(spark, S.frontmatter_field(F.lit(text), "title")) == "t"


@pytest.mark.parametrize(("score", "bad", "want"), [(92, False, "excellent"), (92, True, "good"), (91, False, "good"), (78, False, "good"), (77, False, "partial"), (55, False, "partial"), (54, False, "poor"), (30, False, "poor"), (29, False, "broken")])
def test_grades(spark, score, bad, want):
    v = F.array(F.lit("x")) if bad else F.lit(None).cast("array<string>")
    assert one(spark, rules.grade(F.lit(score), v)) == want


def test_chunks_of_sections(spark):
    long = "word " * 500
    md = f"intro text that is long enough to stay\n# One\n{long}\n## Two\nsame text, long enough to be kept here\n## Two\nsame text, long enough to be kept here\n####### no heading line in here at all"
    docs = spark.createDataFrame([("d", "dom", "T", "https://x/y", "guide", md)], "id string, domain string, title string, url string, type string, markdown string")
    got = chunks.chunk_sections(docs).orderBy("ordinal").collect()
    assert [c.section for c in got] == ["introduction", "one-section-0", "two", "two"]
    assert got[1].metadata["chunkType"] == "content" and got[3].content.endswith("at all")
    aware = chunks.chunk_by_size(docs.withColumn("markdown", F.lit("\n\n".join(f"para{i} " * 100 for i in range(9)))), paragraph_aware=True).collect()
    assert len(aware) > 1
    for text, n in (("x" * 29, 0), ("x" * 30, 1), (None, 0)):
        assert chunks.chunk_by_size(docs.withColumn("markdown", F.lit(text).cast("string"))).count() == n


def test_whole_documents(spark):
    raw = spark.createDataFrame([(1, "https://h/users", _HTML), (2, "https://h/users/", _HTML), (3, None, None)], "page_id long, url string, html string")
    docs = pipeline.rebuild(raw)
    d = docs.where("ord = 1").first()
    # every table feeds the body parameters, and one without a description counts as a placeholder
    assert d.type == "endpoint" and d.extractionQuality == "partial" and d.endpoint.method == "POST" and "api" in d.tags
    made = chunks.chunk_documents(docs.where("ord = 1")).collect()
    assert {"endpoint-overview", "endpoint-params", "endpoint-example-0", "table-fields"} <= {c.section for c in made}
    assert corpus.dedupe_content(docs.where("ord < 3"), "ord").count() == 1
    lines = [json.loads(r.value) for r in pipeline.export(docs.where("ord = 1")).collect()]
    assert len(lines) == len(made) and lines[0]["metadata"]["document_id"] == d.id
    assert writers.markdown_export(docs.where("ord = 1"), F.lit("https://h")).first().path == f"markdown/users/post-users-id-{d.id}.md"


def test_live_snapshot_wins(spark):
    snap = {"method": "PUT", "path": "/a/{b_id}", "pageTitle": "Live", "summary": None, "description": None, "breadcrumbs": ["A", "B"], "serverUrl": None, "bodyParams": [], "headers": [{"name": "Authorization", "type": None, "required": True, "description": None, "default": None, "in": "header"}], "queryParams": [], "responses": [], "tryItSamples": [], "sectionVisibility": {"bodyParamsHeading": True, "headersHeading": True, "queryParamsHeading": True, "responsesUi": True, "tryItTablistCount": 2}}
    parsed = pages.parse_pages(spark.createDataFrame([(1, "https://h/users", _HTML)], "page_id long, url string, html string"))
    shot = spark.createDataFrame([(1, snap)], f"o long, dom_snapshot {schemas.SNAPSHOT}")
    d = pages.documents(parsed.join(shot, F.col("ord") == F.col("o")).drop("o")).first()
    assert d.endpoint.method == "PUT" and d.endpoint.authRequired and d.endpoint.pathParams[0].type == "string" and d.title == "Live" and d.breadcrumbs == ["A", "B"]
    assert d.extractionSignals.domViolations == ["body_params_section_visible_but_empty", "try_it_tabs_present_but_no_samples", "responses_ui_visible_but_empty", "query_params_section_visible_but_empty"]
    static = pages.documents(parsed).select("endpoint").join(shot)
    merged = static.select(rules.merge_endpoint(F.col("endpoint"), F.col("dom_snapshot")).alias("e")).first().e
    assert merged.method == "PUT" and merged.bodyParams[0].name == "name" and merged.examples[0].language == "bash" and merged.pathParams[0].name == "b_id"


def test_frontier(spark):
    urls = spark.createDataFrame([("https://a/x/", 1), ("https://a/x#f", 2), ("https://a/y", 3)], "url string, seq long")
    state = frontier.enqueue(frontier.empty(spark), urls)
    assert [r.url for r in frontier.next_batch(state, 1).collect()] == ["https://a/x"]
    done = spark.createDataFrame([("https://a/x", False, "404")], "url string, ok boolean, reason string")
    state = frontier.enqueue(frontier.mark(state, done), urls)
    assert {r.url: (r.state, r.reason) for r in state.collect()} == {"https://a/x": ("failed", "404"), "https://a/y": ("pending", None)}
    assert {r.state: r.n for r in frontier.snapshot(frontier.restore(state)).collect()} == {"failed": 1, "pending": 1}


def test_reachable_without_a_limit(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(20)] + [("n20", "n3"), ("n5", None), ("z", "y")]
    got = frontier.reachable(spark.createDataFrame(chain, "src string, dst string"), spark.createDataFrame([("n0",)], "url string"))
    assert sorted(map(tuple, got.collect())) == sorted((f"n{i}", i) for i in range(21))


def test_frontier_reads_the_links_of_pages(spark, tmp_path):
    page = lambda *to: "<html><body><main><h1>T</h1><ul>" + "".join(f'<li><a href="{x}">link {x}</a></li>' for x in to) + "</ul></main></body></html>"
    spark.createDataFrame([(1, "https://h/p", page("/q", "/r")), (2, "https://h/q", page("/s"))], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = dict(map(tuple, queries.frontier_links(spark, str(tmp_path)).collect()))
    assert got == {"https://h/p": 0, "https://h/q": 0, "https://h/r": 1, "https://h/s": 1, "a": 0, "b": 1, "c": 2, "d": 2, "e": 3}


def test_architecture_edges_of_all_documents(spark, tmp_path):
    texts = ["Some words about les and more words than twenty signs", "Des mots que " + "x" * 100, "the of it", "y"]
    rows = [(i, t, ["en", "fr", "de", "es"][i]) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.kind, r.position, r.value) for r in queries.architecture_edges(spark, str(tmp_path)).collect() if r.kind != "related"}
    assert got == {("endpoint", i, f"GET /d/{i}") for i in range(4)} | {("page", i, t.lower().replace(" ", "-")) for i, t in enumerate(texts)}


def test_stored_documents_round_trip(spark, tmp_path):
    raw = spark.createDataFrame([(1, "https://h/users", _HTML)], "page_id long, url string, html string")
    docs = pipeline.rebuild(raw).drop("ord", "qualityScore", "issues")
    writers.write_documents(docs, f"{tmp_path}/json")
    got = readers.load_documents(spark, f"{tmp_path}/json")
    good, bad = readers.split_valid(got)
    assert good.count() == 1 and bad.count() == 0 and good.first().endpoint.path == "/users/{id}"
    (tmp_path / "json" / "x-0123456789ab.json").write_text('{"title": "t", "url": "https://h/a"}')
    (tmp_path / "json" / "index.json").write_text("{}")
    (tmp_path / "json" / "y.json").write_text("{broken")
    rows = {r.filename: r for r in readers.load_documents(spark, f"{tmp_path}/json").collect()}
    assert rows["x-0123456789ab.json"].id == "0123456789ab" and rows["x-0123456789ab.json"].problem and rows["y.json"].problem == "json" and "index.json" not in rows
    assert readers.navigation(spark, f"{tmp_path}/none.json").count() == 0


def test_stream_keeps_first_content(spark, tmp_path):
    page = lambda i, h: (i, f"https://h/{i}", f"<h1>{h}</h1><p>text of {h}</p>")
    ddl = ingest.PAGE_SCHEMA
    for rows in ([page(2, "a"), page(1, "a"), page(3, "b")], [page(4, "b"), page(5, "c")]):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest.ingest(ingest.stream_pages(spark, f"{tmp_path}/in"), f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    assert sorted(r.ord for r in spark.read.parquet(f"{tmp_path}/store").select("ord").collect()) == [1, 3, 5]


def test_api_calls(spark):
    calls = spark.createDataFrame([("https://h/openapi.json", "GET", "xhr", {"Cookie": "s", "A": "b"}, None, '{"openapi": "3"}', 200, ""), ("https://h/graphql", "POST", "xhr", {"X-Auth-Token": "s"}, "query {x}", "oops", 200, ""), ("https://h/x", "GET", "xhr", {}, None, "{}", 200, "")], schemas.API_CALL)
    spec = api.openapi_specs(calls).collect()
    assert len(spec) == 1 and spec[0].headers == {"Cookie": "[REDACTED]", "A": "b"} and spec[0].filename.endswith(".json")
    gql = api.graphql_payloads(calls).first()
    assert gql.headers == {"X-Auth-Token": "s"} and json.loads(gql.request) == {"raw": "query {x}"} and json.loads(gql.response) == {"raw": "oops"}


def test_navigation_lists(spark):
    raw = spark.createDataFrame([(1, "https://h/users", _HTML)], "page_id long, url string, html string")
    nav = pages.nav_rows(pages.parse_pages(raw))
    moved = navigation.under_domain(nav, "v1-cards").orderBy("ord").first()
    assert moved.navPath[0] == "v1-cards" and moved.pathTitles[0] == "Cards"
    tree = navigation.tree_rows(nav)
    assert navigation.flatten_tree(tree).count() == 4 and navigation.folders(tree).where("domain = 'guide'").first().slugs == ["guide", "alpha", "beta-page"]


def test_settings():
    with pytest.raises(ValueError):
        pipeline.Settings(concurrency=99)
    assert pipeline.Settings().chunk_max_tokens == 512


def test_store_reorganize_and_load_again(spark, tmp_path):
    raw = spark.createDataFrame([(1, "https://h/bank/a", "<h1>Alpha page</h1><p>one</p>"), (2, "https://h/bank/b", "<h1>Beta page</h1><p>two</p>"), (3, "https://h/start/c", "<h1>Gamma page</h1>")], "page_id long, url string, html string")
    folder = str(tmp_path / "store")
    assert writers.store(pipeline.rebuild(raw), S.url_origin(F.col("url")), folder) == 6
    (tmp_path / "store/json/bank/broken.json").write_text("{")
    load = lambda: readers.load_documents(spark, f"{folder}/json", f"{folder}/markdown")
    first = {r.url: r for r in load().where("problem is null").collect()}
    assert sorted(first) == ["https://h/bank/a", "https://h/bank/b", "https://h/start/c"] and "one" in first["https://h/bank/a"].markdown
    nav = spark.createDataFrame([("https://h/bank/b", "Beta", "b", "cards", 2, 0, "sec", ["cards", "sec", "b"], ["Cards", "Sec", "Beta"], 1), ("https://h/start/c", "Gamma", "c", "late", 1, 0, None, ["late", "c"], ["Late", "Gamma"], 2)], schemas.NAV)
    before = sorted(str(p.relative_to(folder)) for p in (tmp_path / "store").rglob("*") if p.is_file())
    want = {"moved": 2, "unchanged": 1, "skipped": 1}
    assert pipeline.reorganize(load(), nav, S.url_origin(F.col("url")), folder, dry_run=True) == want
    assert sorted(str(p.relative_to(folder)) for p in (tmp_path / "store").rglob("*") if p.is_file()) == before
    assert pipeline.reorganize(load(), nav, S.url_origin(F.col("url")), folder) == want
    after = {r.url: r for r in load().where("problem is null").collect()}
    assert {u: r.rel_path.rpartition("/")[0] for u, r in after.items()} == {"https://h/bank/a": "bank", "https://h/bank/b": "cards/sec", "https://h/start/c": "late"}
    assert after["https://h/bank/b"].breadcrumbs == ["Cards", "Sec", "Beta"] and after["https://h/bank/b"].markdown.endswith(first["https://h/bank/b"].markdown[-8:])
    assert not (tmp_path / "store/json/start").exists() and not (tmp_path / "store/markdown/start").exists()
    assert sorted(p.name for p in (tmp_path / "store/index").iterdir()) == ["bank.jsonl", "cards.jsonl", "late.jsonl"]
    again = pipeline.reorganize(load(), nav, S.url_origin(F.col("url")), folder)
    assert again == {"moved": 0, "unchanged": 3, "skipped": 1}
