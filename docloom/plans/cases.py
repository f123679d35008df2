"""Operators that no column of the test tables exercises, on hand-written pages and rows; the oracle states the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import rules
from docloom.functions import scalars as S
from docloom.operators import api, chunks, frontier, navigation, pages
from docloom.plans.catalogue import register

_CREATE = """<html><head><title>Create user</title></head><body><aside><nav><ul>
<li><a href='/g'>Guide</a><ul><li><a href='/g/a'>Alpha</a></li></ul></li></ul></nav></aside>
<main><h1>Create user</h1><span class='http-verb'>POST</span> <code>/users/{id}</code><p>Makes a user. Needs a Bearer token.</p>
<h2>Body params</h2><table><caption>Fields</caption><thead><tr><th>Name</th><th>Type</th><th>Required</th><th>Description</th></tr></thead>
<tbody><tr><td>name</td><td>string</td><td>yes</td><td>Full name</td></tr><tr><td></td><td></td><td></td><td></td></tr></tbody></table>
<h2>Responses</h2><table><tbody><tr><td>200</td><td>OK</td></tr><tr><td>404</td><td>Missing</td><td>{}</td></tr></tbody></table>
<h3>Example</h3><pre><code class='language-bash'>curl --request POST --url https://h/users</code></pre>
<h3>User object</h3><pre>{"type": "object", "properties": {"id": {"type": "string"}}, "required": ["id"]}</pre></main></body></html>"""

_FIELDS = """<html><head><title>ReadMe</title><meta name="description" content="Changes one account of the bank."></head><body><article>
<div class="rm-Article"><h1>Update account</h1><span class="rm-APIMethod">PUT</span>
<span data-testid="serverurl" title="https://api.h/v2/accounts/{accountId}/limits">x</span>
<header class="x"><h3 class="APISectionHeader-heading1">Body Params</h3></header><div class="rm-ParamContainer">
<div class="form-group field"><label class="Param-name1" for="a_b_name">name</label><span class="Param-type2">string</span><span class="Param-required3">required</span>
<div class="field-description"><p>Who</p></div><input id="a_b_name" placeholder="Ann"></div>
<div class="form-group field"><label class="Param-name1">Loading</label></div></div>
<div class="APIResponseSchemaPicker-option1"><span aria-label="404"></span><span class="APIResponseSchemaPicker-description1">Missing</span></div>
<div class="APIResponseSchemaPicker-option1"><span class="APIResponseSchemaPicker-label1">200</span></div>
<h2>Request</h2><pre>{"limit": 10}</pre></div></article></body></html>"""

_GUIDE = """<html><body><nav class="breadcrumbs"><a>Docs</a><a>Start</a></nav><main><h1>Getting started</h1><p>First words.</p>
<h2 id="inst">Install</h2><ol><li>one</li><li>two</li></ol><pre><code>import os
print(1)</code></pre><table><tr><td>k</td><td>v</td></tr><tr><td>a</td><td>1</td></tr></table></main></body></html>"""

_CASES = [(1, "https://h/v1-users/create", _CREATE), (2, "https://h/bank/reference/update-account", _FIELDS), (3, "https://h/docs/getting-started", _GUIDE), (4, "https://h/", None)]


def values(columns: str, rows: list[tuple]) -> str:
    """SQL of the rows; columns: name type, ... in DuckDB's words."""
    named = [c.rsplit(" ", 1) for c in columns.split(", ")]

    def cell(v, kind):
        if v is None:
            return f"CAST(NULL AS {kind})"
        text = str(v).replace("'", "''").replace("\n", "' || chr(10) || '")
        return f"CAST('{text}' AS {kind})"

    body = ", ".join("(" + ", ".join(cell(v, kind) for v, (_, kind) in zip(r, named, strict=True)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(f'"{n}"' for n, _ in named)})"


def _parsed(spark) -> DataFrame:
    return pages.parse_pages(spark.createDataFrame(_CASES, "page_id long, url string, html string"))


def _join(items, between="|"):
    return F.array_join(items, between, "")


@register("endpoint_extract", values("page_id BIGINT, method VARCHAR, path VARCHAR, summary VARCHAR, description VARCHAR, path_params VARCHAR, request VARCHAR, response VARCHAR, auth BOOLEAN", [
    (1, 'POST', '/users/{id}', 'Create user', 'Makes a user. Needs a Bearer token.', 'id', '{"type":"object","properties":{"id":{"type":"string"}},"required":["id"]}', '{"type":"object","properties":{"id":{"type":"string"}},"required":["id"]}', True),
    (2, 'PUT', '/v2/accounts/%7BaccountId%7D/limits', 'Update account', 'Changes one account of the bank.\n\nBase URL: https://api.h/v2/accounts/{accountId}/limits', '', '{"limit":10}', '{"limit":10}', False),
]))
def endpoint_extract(spark, d):
    e = F.col("endpoint")
    names = _join(F.transform(e["pathParams"], lambda p: p["name"]))
    return _parsed(spark).where(e.isNotNull()).select(F.col("ord").alias("page_id"), e["method"].alias("method"), e["path"].alias("path"), e["summary"].alias("summary"), e["description"].alias("description"), names.alias("path_params"), e["request"].alias("request"), e["response"].alias("response"), e["authRequired"].alias("auth"))


@register("endpoint_params", values("page_id BIGINT, place VARCHAR, name VARCHAR, type VARCHAR, required BOOLEAN, description VARCHAR, given VARCHAR", [
    (1, 'body', 'name', 'string', True, 'Full name', None),
    (1, 'body', '200', None, False, None, None),
    (1, 'body', '404', None, False, None, None),
    (1, 'path', 'id', None, True, None, None),
    (1, 'query', 'name', 'string', True, 'Full name', None),
    (2, 'body', 'name', 'string', True, 'Who', 'Ann'),
]))
def endpoint_params(spark, d):
    e = F.col("endpoint")
    every = F.concat(e["headers"], e["queryParams"], e["pathParams"], e["bodyParams"])
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.explode(every).alias("p")).select("page_id", F.col("p.in").alias("place"), "p.name", "p.type", "p.required", "p.description", F.col("p.default").alias("given"))


@register("endpoint_responses", values("page_id BIGINT, place INTEGER, status VARCHAR, description VARCHAR, example VARCHAR", [
    (1, 0, '200', 'OK', None),
    (1, 1, '404', 'Missing', '{}'),
    (2, 0, '200', '200', None),
    (2, 1, '404', 'Missing', None),
]))
def endpoint_responses(spark, d):
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.posexplode("endpoint.responses").alias("place", "r")).select("page_id", "place", F.col("r.statusCode").alias("status"), "r.description", "r.example")


@register("endpoint_examples", values("page_id BIGINT, place INTEGER, language VARCHAR, code VARCHAR, label VARCHAR", [
    (1, 0, 'bash', 'curl --request POST --url https://h/users', 'Try It'),
    (2, 0, 'text', '{"limit": 10}', 'Try It'),
]))
def endpoint_examples(spark, d):
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.posexplode("endpoint.examples").alias("place", "e")).select("page_id", "place", "e.language", "e.code", "e.label")


@register("html_tables", values("page_id BIGINT, place INTEGER, caption VARCHAR, headers VARCHAR, rows VARCHAR", [
    (1, 0, 'Fields', 'Name|Type|Required|Description', 'name|string|yes|Full name'),
    (1, 1, None, '200|OK', '404|Missing|{}'),
    (3, 0, None, 'k|v', 'a|1'),
]))
def html_tables(spark, d):
    rows = _join(F.transform("t.rows", lambda r: _join(r)), ";")
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.posexplode("tables").alias("place", "t")).select("page_id", "place", "t.caption", _join("t.headers").alias("headers"), rows.alias("rows"))


@register("html_code", values("page_id BIGINT, place INTEGER, language VARCHAR, code VARCHAR, label VARCHAR", [
    (1, 0, 'bash', 'curl --request POST --url https://h/users', 'Example'),
    (1, 1, 'json', '{"type": "object", "properties": {"id": {"type": "string"}}, "required": ["id"]}', 'User object'),
    (2, 0, 'json', '{"limit": 10}', None),
    (3, 0, 'typescript', 'import os\nprint(1)', None),
]))
def html_code(spark, d):
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.posexplode("code").alias("place", "c")).select("page_id", "place", "c.language", "c.code", "c.label")


@register("html_schemas", values("page_id BIGINT, place INTEGER, language VARCHAR, code VARCHAR, label VARCHAR", [
    (1, 0, 'json', '{"type": "object", "properties": {"id": {"type": "string"}}, "required": ["id"]}', 'User object'),
    (2, 0, 'json', '{"limit": 10}', 'Request'),
]))
def html_schemas(spark, d):
    return _parsed(spark).select(F.col("ord").alias("page_id"), F.posexplode("schema_blocks").alias("place", "c")).select("page_id", "place", "c.language", "c.code", "c.label")


@register("html_content", values("page_id BIGINT, framework VARCHAR, title VARCHAR, description VARCHAR, headings VARCHAR, breadcrumbs VARCHAR, markdown VARCHAR", [
    (1, 'unknown', 'Create user', 'Makes a user. Needs a Bearer token.', '1 Create user|2 Body params|2 Responses|3 Example|3 User object', '', '# Create user\n\nPOST `/users/{id}`\n\nMakes a user. Needs a Bearer token.\n\n## Body params\n\n| Name | Type | Required | Description |\n| --- | --- | --- | --- |\n| name | string | yes | Full name |\n|  |  |  |  |\n\n## Responses\n\n| 200 | OK |  |\n| --- | --- | --- |\n| 404 | Missing | {} |\n\n### Example\n\n```bash\ncurl --request POST --url https://h/users\n```\n\n### User object\n\n```\n{"type": "object", "properties": {"id": {"type": "string"}}, "required": ["id"]}\n```'),
    (2, 'readme', 'Update account', 'Who', '1 Update account|2 Request', '', '# Update account\n\nPUT x\n\nnamestringrequired\n\nWho\n\nLoading\n\nMissing\n\n200\n\n## Request\n\n```\n{"limit": 10}\n```'),
    (3, 'unknown', 'Getting started', 'First words.', '1 Getting started|2 Install inst', '', '# Getting started\n\nFirst words.\n\n## Install\n\n1.  one\n2.  two\n\n```\nimport os\nprint(1)\n```\n\n| k | v |\n| --- | --- |\n| a | 1 |'),
    (4, 'unknown', 'Untitled', '', '', '', ''),
]))
def html_content(spark, d):
    heads = _join(F.transform("headings", lambda h: F.concat_ws(" ", h["level"].cast("string"), h["text"], h["id"])))
    return _parsed(spark).select(F.col("ord").alias("page_id"), "framework", "title", "description", heads.alias("headings"), _join("breadcrumbs").alias("breadcrumbs"), "markdown")


@register("document_fields", values("page_id BIGINT, id VARCHAR, title VARCHAR, domain VARCHAR, subcategory VARCHAR, type VARCHAR, tags VARCHAR, quality VARCHAR, score INTEGER, grade VARCHAR, issues VARCHAR, code_blocks BIGINT", [
    (1, '0a4b8752df6b', 'Create user', 'v1-users', 'create', 'endpoint', 'v1-users|endpoint|create|post|api', 'partial', 76, 'partial', 'params_placeholder', 3),
    (2, '3719ca01960d', 'Update account', 'bank', 'update-account', 'endpoint', 'bank|endpoint|update-account|put|api', 'complete', 76, 'partial', '', 2),
    (3, 'afad375385c3', 'Getting Started', 'docs', 'getting-started', 'overview', 'docs|overview|getting-started', 'complete', 60, 'partial', '', 1),
    (4, 'bd35d688dc5e', 'Index', 'general', 'index', 'concept', 'general|concept|index', 'complete', 20, 'broken', '', 0),
]))
def document_fields(spark, d):
    docs = pages.documents(_parsed(spark))
    return docs.select(F.col("ord").alias("page_id"), "id", "title", "domain", "subcategory", "type", _join("tags").alias("tags"), F.col("extractionQuality").alias("quality"), "qualityScore.score", "qualityScore.grade", _join("issues").alias("issues"), F.size("codeBlocks").cast("long").alias("code_blocks"))


@register("endpoint_chunks", values("ordinal INTEGER, section VARCHAR, chunk_type VARCHAR, embedding_hint VARCHAR, content VARCHAR", [
    (0, 'endpoint-overview', 'endpoint', 'POST /users/{id}', '# Create user\n\n**POST** `/users/{id}`\n\nCreate user\n\nMakes a user. Needs a Bearer token.'),
    (1, 'endpoint-params', 'parameters', 'POST /users/{id} parameters', '## Parameters\n\n- **id** (string, path, required):\n- **name** (string, query, required): Full name\n- **name** (string, body, required): Full name\n- **200** (string, body):\n- **404** (string, body):'),
    (2, 'endpoint-example-0', 'example', 'POST /users/{id} example', '```bash\ncurl --request POST --url https://h/users\n```'),
    (3, 'endpoint-responses', 'response', 'POST /users/{id} responses', '### 200\nOK\n\n### 404\nMissing\n{}'),
    (4, 'create-user', 'section', 'POST /users/{id}', '# Create user\n\nPOST `/users/{id}`\n\nMakes a user. Needs a Bearer token.'),
    (5, 'body-params', 'section', 'POST /users/{id}', '## Body params\n\n| Name | Type | Required | Description |\n| --- | --- | --- | --- |\n| name | string | yes | Full name |\n|  |  |  |  |'),
    (6, 'responses', 'section', 'POST /users/{id}', '## Responses\n\n| 200 | OK |  |\n| --- | --- | --- |\n| 404 | Missing | {} |'),
    (7, 'example', 'section', 'POST /users/{id}', '### Example\n\n```bash\ncurl --request POST --url https://h/users\n```'),
    (8, 'user-object', 'section', 'POST /users/{id}', '### User object\n\n```\n{"type": "object", "properties": {"id": {"type": "string"}}, "required": ["id"]}\n```'),
    (9, 'table-fields', 'table', 'POST /users/{id}', 'Table: Fields\n| Name | Type | Required | Description |\n| name | string | yes | Full name |'),
    (10, 'table-data', 'table', 'POST /users/{id}', 'Table: Parameters\n| 200 | OK |\n| 404 | Missing | {} |'),
]))
def endpoint_chunks(spark, d):
    docs = pages.documents(_parsed(spark)).where("ord = 1")
    return chunks.chunk_documents(docs).select("ordinal", "section", F.col("metadata.chunkType").alias("chunk_type"), "embedding_hint", "content")


_SNAPSHOTS = [
    ("clean", "POST", "/a/{id}", "https://api.h", "Live text that is longer", ["x"], ["200"], [("bash", "curl 1"), ("bash", "curl -H 'Authorization: x'"), ("go", "g")], True, 2),
    ("bare", "PUT", None, None, "Short", [], [], [], True, 2),
    ("none", None, None, None, None, [], [], [], False, 0),
]


def _snapshots(spark) -> DataFrame:
    rows = spark.createDataFrame(_SNAPSHOTS, "name string, method string, path string, server string, description string, params array<string>, codes array<string>, samples array<struct<language:string,code:string>>, shown boolean, tabs int")
    none = F.lit(None).cast("string")
    param = lambda p: F.struct(p.alias("name"), F.lit("string").alias("type"), F.lit(True).alias("required"), none.alias("description"), none.alias("default"), F.lit("body").alias("in"))
    code = lambda c: F.struct(c.alias("statusCode"), F.lit("said").alias("description"), none.alias("schema"), none.alias("example"))
    sample = lambda s: F.struct(s["language"].alias("language"), s["code"].alias("code"), F.lit("Live").alias("label"), none.alias("sourceTab"), none.alias("snippetHash"), none.alias("exampleType"))
    empty = F.expr(f"cast(array() as array<{schemas.PARAM}>)")
    seen = F.struct(F.col("shown").alias("bodyParamsHeading"), F.lit(False).alias("headersHeading"), F.lit(False).alias("queryParamsHeading"), F.col("shown").alias("responsesUi"), F.col("tabs").alias("tryItTablistCount"))
    dom = F.struct(
        F.lit("Live title").alias("pageTitle"), F.col("description").alias("description"), F.array(F.lit("Home")).alias("breadcrumbs"), F.col("method").alias("method"), F.col("path").alias("path"), F.col("server").alias("serverUrl"),
        F.concat(F.lit("Live "), "name").alias("summary"), F.transform("params", param).alias("bodyParams"), empty.alias("headers"), empty.alias("queryParams"), F.transform("codes", code).alias("responses"), F.transform("samples", sample).alias("tryItSamples"),
        seen.alias("sectionVisibility"),
    )
    return rows.select("name", dom.cast(schemas.SNAPSHOT).alias("dom"))


@register("snapshot_checks", values("name VARCHAR, violations VARCHAR", [
    ('bare', 'body_params_section_visible_but_empty|try_it_tabs_present_but_no_samples|responses_ui_visible_but_empty'),
    ('clean', ''),
    ('none', ''),
]))
def snapshot_checks(spark, d):
    return _snapshots(spark).select("name", _join(rules.snapshot_violations(F.col("dom"))).alias("violations"))


@register("snapshot_endpoints", values("name VARCHAR, method VARCHAR, path VARCHAR, summary VARCHAR, path_params VARCHAR, auth BOOLEAN, examples BIGINT", [
    ('clean', 'POST', '/a/{id}', 'Live clean', 'id', True, 3),
]))
def snapshot_endpoints(spark, d):
    e = rules.endpoint_from_snapshot(F.col("dom"))
    return _snapshots(spark).select("name", e.alias("e")).where("e is not null").select("name", "e.method", "e.path", "e.summary", _join(F.col("e.pathParams.name")).alias("path_params"), F.col("e.authRequired").alias("auth"), F.size("e.examples").cast("long").alias("examples"))


@register("merged_endpoints", values("name VARCHAR, method VARCHAR, path VARCHAR, summary VARCHAR, description VARCHAR, body VARCHAR, path_params VARCHAR, codes VARCHAR, examples VARCHAR, auth BOOLEAN", [
    ('bare', 'PUT', '/users/{id}', 'Live bare', 'Makes a user. Needs a Bearer token.', 'name|200|404', 'id', '200|404', 'bash:curl --request POST --url https://h/users', True),
    ('clean', 'POST', '/a/{id}', 'Live clean', 'Makes a user. Needs a Bearer token.\n\nBase URL: https://api.h', 'x', 'id', '200', "bash:curl -H 'Authorization: x'|go:g", True),
    ('none', 'POST', '/users/{id}', 'Live none', 'Makes a user. Needs a Bearer token.', 'name|200|404', 'id', '200|404', 'bash:curl --request POST --url https://h/users', True),
]))
def merged_endpoints(spark, d):
    static = _parsed(spark).where("ord = 1").select("endpoint")
    both = _snapshots(spark).crossJoin(F.broadcast(static))  # one row
    e = rules.merge_endpoint(F.col("endpoint"), F.col("dom"))
    return both.select("name", e.alias("e")).select(
        "name", "e.method", "e.path", "e.summary", "e.description", _join(F.col("e.bodyParams.name")).alias("body"), _join(F.col("e.pathParams.name")).alias("path_params"), _join(F.col("e.responses.statusCode")).alias("codes"),
        _join(F.transform("e.examples", lambda x: F.concat_ws(":", x["language"], x["code"]))).alias("examples"), F.col("e.authRequired").alias("auth"),
    )


@register("endpoint_quality", values("name VARCHAR, score BIGINT, grade VARCHAR, issues VARCHAR, quality VARCHAR", [
    ('bare', 42, 'poor', 'bad_title|missing_body_params|no_responses|no_examples', 'partial'),
    ('odd', 80, 'good', 'dom_assertion_failed|params_placeholder', 'partial'),
    ('page', 80, 'good', '', 'complete'),
    ('whole', 92, 'excellent', 'params_placeholder', 'partial'),
]))
def endpoint_quality(spark, d):
    """The endpoint of page 1 as it is, less its lists, and with placeholders, and a plain page."""
    e = F.col("endpoint")
    none = F.expr("cast(array() as array<string>)")
    bare = e.withField("bodyParams", F.slice(e["bodyParams"], 1, 0)).withField("responses", F.slice(e["responses"], 1, 0)).withField("response", F.lit(None).cast("string")).withField("examples", F.slice(e["examples"], 1, 0))
    odd = e.withField("bodyParams", F.transform(e["bodyParams"], lambda p: p.withField("name", F.lit("Loading…"))))
    kinds = F.array(*[F.struct(F.lit(n).alias("name"), x.alias("e"), F.lit(t).alias("title"), k.alias("code"), F.lit(kind).alias("kind"), F.lit(live).alias("live"), v.alias("violations")) for n, x, t, k, kind, live, v in (
        ("whole", e, "Create user", F.col("code"), "endpoint", True, none), ("bare", bare, "200 OK", F.slice("code", 1, 0), "endpoint", False, none), ("odd", odd, "Create user", F.col("code"), "endpoint", True, F.array(F.lit("x"))),
        ("page", F.when(F.lit(False), e), "Guide", F.slice("code", 1, 0), "guide", False, none),
    )])
    rows = _parsed(spark).where("ord = 1").select("markdown", F.explode(kinds).alias("k")).select("markdown", "k.*")
    score = rules.quality_score(F.col("kind"), F.col("e"), F.col("title"), F.col("code"), F.array(F.lit("a"), F.lit("b")), F.col("live"), F.col("violations"))
    issues = rules.quality_issues(F.col("title"), F.lit("text"), F.col("markdown"), F.col("kind"), F.col("e"), F.col("code"), F.col("violations"))
    return rows.select("name", score.alias("s"), issues.alias("i")).select("name", F.col("s.score").cast("long").alias("score"), "s.grade", _join("i").alias("issues"), rules.extraction_quality(F.col("i")).alias("quality"))


_TREE = [(["b"], "B", "https://h/b", 0, 2), (["a"], "A", None, 0, 1), (["a", "z"], "Z", "https://h/a/z", 1, 0), (["a", "y"], "Y", "https://h/a/y", 1, 1), (["a", "y", "q"], "Q", "https://h/a/y/q", 2, 0), (["b", "c"], "C", "https://h/b/c", 1, 0)]


@register("nav_preorder", values("url VARCHAR, title VARCHAR, domain VARCHAR, parentSlug VARCHAR, place BIGINT", [
    ('https://h/a/y', 'Y', 'a', 'a', 2),
    ('https://h/a/y/q', 'Q', 'a', 'y', 3),
    ('https://h/a/z', 'Z', 'a', 'a', 1),
    ('https://h/b', 'B', 'b', None, 4),
    ('https://h/b/c', 'C', 'b', 'b', 5),
]))
def nav_preorder(spark, d):
    tree = spark.createDataFrame(_TREE, "path array<string>, title string, url string, depth int, `order` int")
    return navigation.flatten_tree(tree).select("url", "title", "domain", "parentSlug", F.row_number().over(_by("ord")).cast("long").alias("place"))


def _by(c):
    from pyspark.sql import Window

    return Window.orderBy(c)  # over a handful of literal rows


@register("small_values", values("name VARCHAR, value VARCHAR", [
    ('badge', '**GET** `/x`\n\n# T\n\ntext'),
    ('chunk empty', 'false'),
    ('chunk ok', 'true'),
    ('chunk path', 'chunks/bank/abc.json'),
    ('chunk url', 'false'),
    ('graphql', 'true'),
    ('milestone', 'true'),
    ('not root', 'false'),
    ('openapi', 'true'),
    ('relative', 'a/b.json'),
    ('retry 1', '500.0'),
    ('retry 3', '2000.0'),
    ('root', 'true'),
    ('root url', 'https://h/bank/reference'),
    ('sidebar', 'Create a card'),
    ('sniffed', 'bash'),
    ('tab', 'python'),
    ('tags', 'a|b'),
]))
def small_values(spark, d):
    """Functions of one value, by name."""
    lit = F.lit
    cells = {
        "retry 1": S.retry_wait(lit(500), lit(1)), "retry 3": S.retry_wait(lit(500), lit(3)), "sidebar": S.clean_sidebar_title(lit("Create a card  post")), "tab": S.sample_language(lit("x"), lit("Python")), "sniffed": S.sample_language(lit("curl --request GET"), lit(None).cast("string")),
        "chunk ok": rules.chunk_is_valid(lit("x"), lit("https://h/a")), "chunk empty": rules.chunk_is_valid(lit(""), lit("https://h/a")), "chunk url": rules.chunk_is_valid(lit("x"), lit("nowhere")),
        "root": S.is_domain_root(lit("https://h/bank/reference")), "not root": S.is_domain_root(lit("https://h/bank/reference/x")), "root url": S.domain_root_url(lit("bank"), lit("https://h")),
        "relative": S.relative_path(lit("/store/json/a/b.json"), "/store/json"), "chunk path": S.chunk_path(lit("bank"), lit("abc")), "openapi": rules.is_openapi_url(lit("https://h/openapi.json")), "graphql": rules.is_graphql_url(lit("https://h/graphql")),
        "badge": S.with_badge(lit("# T\n\ntext"), lit("GET"), lit("/x")), "tags": F.array_join(S.frontmatter_tags(lit('---\ntags:\n  - "a"\n  - b\n---\n')), "|"), "milestone": frontier.progress_milestone(lit(50), lit(200), 25),
    }
    row = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.cast("string").alias("value")) for k, v in cells.items()])).alias("x"))
    return row.select("x.name", "x.value")


_CALLS = [
    ("https://h/openapi.json", "GET", "xhr", {"Authorization": "secret", "Accept": "json"}, None, '{"openapi": "3.0.0", "paths": {}}', 200, "t"),
    ("https://h/swagger.yaml", "GET", "swagger", {}, None, "swagger: '2.0'", 200, "t"),
    ("https://h/openapi/none", "GET", "openapi", {}, None, '{"a": 1}', 200, "t"),
    ("https://h/graphql", "POST", "fetch", {"cookie": "c", "X": "y"}, '{"query": "query A { a }"}', "not json", 200, "t"),
    ("https://h/other", "POST", "fetch", {}, "{}", "{}", 200, "t"),
]


@register("intercepted_specs", values("url VARCHAR, filename VARCHAR, headers VARCHAR, body VARCHAR", [
    ('https://h/openapi.json', 'openapi-20c97dac93b3.json', 'Accept=json|Authorization=[REDACTED]', '{"openapi": "3.0.0", "paths": {}}'),
    ('https://h/swagger.yaml', 'openapi-f2c39259675a.yaml', '', "swagger: '2.0'"),
]))
def intercepted_specs(spark, d):
    out = api.openapi_specs(spark.createDataFrame(_CALLS, schemas.API_CALL))
    return out.select("url", "filename", _join(F.array_sort(F.transform(F.map_entries("headers"), lambda h: F.concat_ws("=", h["key"], h["value"])))).alias("headers"), "body")


@register("intercepted_graphql", values("url VARCHAR, filename VARCHAR, headers VARCHAR, request VARCHAR, response VARCHAR", [
    ('https://h/graphql', 'graphql-cad24daa877a.json', 'X=y|cookie=[REDACTED]', '{"query": "query A { a }"}', '{"raw":"not json"}'),
]))
def intercepted_graphql(spark, d):
    out = api.graphql_payloads(spark.createDataFrame(_CALLS, schemas.API_CALL))
    return out.select("url", "filename", _join(F.array_sort(F.transform(F.map_entries("headers"), lambda h: F.concat_ws("=", h["key"], h["value"])))).alias("headers"), "request", "response")


@register("list_dedupe", values("params VARCHAR, codes VARCHAR, labels VARCHAR", [
    ('name|200|404', '200|404', 'Example|User object|again|again'),
]))
def list_dedupe(spark, d):
    e = F.col("endpoint")
    twice = lambda a, b: F.concat(a, F.transform(a, b))
    params = twice(e["bodyParams"], lambda p: p.withField("name", F.concat(F.upper(p["name"]), F.lit(" "))))
    responses = F.concat(F.reverse(e["responses"]), F.transform(e["responses"], lambda r: r.withField("example", F.lit(None).cast("string"))))
    code = twice(F.col("code"), lambda c: c.withField("label", F.lit("again")))
    out = _parsed(spark).where("ord = 1").select(S.dedupe_params(params).alias("p"), S.dedupe_responses(responses).alias("r"), S.dedupe_code(code).alias("c"))
    return out.select(_join(F.col("p.name")).alias("params"), _join(F.col("r.statusCode")).alias("codes"), _join(F.col("c.label")).alias("labels"))
