"""Classification ladders, predicates and scores over page and document columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import scalars as S

#: Signs of documentation frameworks in a page's source, in the order they are tried.
FRAMEWORKS = (
    ("readme", r"(?i)readme\.io|rm-Sidebar|rm-Article|data-readme"),
    ("docusaurus", r"(?i)docusaurus|theme-doc|__docusaurus"),
    ("mintlify", r"(?i)mintlify|mint\.dev|#content-area"),
    ("redoc", r"(?i)redoc|\.redoc-wrap"),
    ("swagger-ui", r"(?i)swagger-ui|#swagger-ui"),
    ("stoplight", r"(?i)stoplight|elements-api"),
    ("gitbook", r"(?i)gitbook|gitbook\.io"),
    ("readme", r"(?i)readme|rm-Sidebar"),
)

BAD_TITLE = r"(?i)^(200\s*ok?|200|loading|untitled|page)\z"
BAD_AUDIT_TITLE = r"(?i)^(200\s*ok?|200|loading|untitled)\z"

#: URLs that are never followed.
IGNORED_URLS = (
    r"(?i)logout", r"(?i)signout", r"(?i)sign-out", r"(?i)\.(png|jpg|jpeg|gif|svg|ico|woff2?|ttf|eot|css|js|map)(\?|\z)", r"#\z", r"(?i)^mailto:", r"(?i)^tel:", r"(?i)javascript:",
)
OPENAPI_URLS = r"(?i)openapi\.json|openapi\.yaml|swagger\.json|swagger\.yaml|api-docs|v\d+/openapi"
GRAPHQL_URLS = r"(?i)graphql|/gql\b"


def framework(html: Column) -> Column:
    out = F.lit("unknown")
    for name, pattern in reversed(FRAMEWORKS):
        out = F.when(html.rlike(pattern), name).otherwise(out)
    return out


def document_type(has_endpoint: Column, title: Column, url: Column) -> Column:
    title, url = F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))
    both = F.concat(title, url)
    return (
        F.when(has_endpoint, "endpoint")
        .when(F.concat_ws(" ", title, url).rlike(r"(?i)webhook|webhooks|callback(\s|-)?url"), "webhook")
        .when(url.rlike(r"(?iu)/oauth|/openid|/token|/authorize|authentication|autentica(c|ç)ão|login|password\s*grant") | title.rlike(r"(?i)\b(auth|oauth|token)\b"), "auth")
        .when(both.rlike(r"(?iu)overview|sobre|introduction|introdução|getting started"), "overview")
        .when(title.rlike(r"(?i)schema|model|object"), "schema").when(title.rlike(r"(?i)guide|tutorial|how to"), "guide").when(title.rlike(r"(?i)changelog|release"), "changelog").otherwise("concept")
    )


def tags(domain: Column, subcategory: Column, kind: Column, method: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(domain, kind, F.when(subcategory != domain, subcategory), F.lower(method), F.when(method.isNotNull(), "api"))))


def should_crawl(url: Column, base_url: Column, docs_host: str | None = None) -> Column:
    """http(s) on the base's host, none of the ignored patterns, no login path; on docs_host only reference paths."""
    path, host = S.url_path(url), S.url_host(url)
    ok = S.is_url(url) & S.url_scheme(url).isin("http", "https") & (host == S.url_host(base_url))
    for pattern in IGNORED_URLS:
        ok = ok & ~url.rlike(pattern)
    ok = ok & ~path.rlike(r"(?i)/(logout|signout|sign-out|login)(\?|\z|/)")
    if docs_host:
        ok = ok & (~F.contains(host, F.lit(docs_host)) | path.rlike(r"(?i)^/reference(/|\z)") | path.rlike(r"(?i)^/v1-[^/]+/reference(/|\z)"))
    return F.coalesce(ok, F.lit(False))


def is_openapi_url(url: Column) -> Column:
    return url.rlike(OPENAPI_URLS)


def is_graphql_url(url: Column) -> Column:
    return url.rlike(GRAPHQL_URLS)


def is_reference_page(url: Column, host: Column) -> Column:
    return S.is_url(url) & (S.url_host(url) == host) & F.contains(S.url_path(url), F.lit("/reference/"))


# titles


def _titled(c: Column) -> Column:
    return F.when(c.isNotNull() & ~S.trim(c).rlike(BAD_TITLE), c)


def title_from_path(titles: Column) -> Column:
    leaf = S.trim(F.when(F.size(titles) > 0, F.element_at(titles, -1)))
    return F.when((leaf != "") & ~leaf.rlike(BAD_TITLE), S.clean_sidebar_title(leaf))


def title_from_section(titles: Column) -> Column:
    leaf, section = S.trim(F.when(F.size(titles) > 1, F.element_at(titles, -1))), S.trim(F.when(F.size(titles) > 1, F.element_at(titles, -2)))
    both = F.concat(S.clean_sidebar_title(section), F.lit(" — "), S.clean_sidebar_title(leaf))
    return F.when((section != "") & (leaf != "") & ~leaf.rlike(BAD_TITLE), F.when(section.rlike(BAD_TITLE), S.clean_sidebar_title(leaf)).otherwise(both))


def resolve_title(title: Column, kind: Column, endpoint: Column, url: Column, nav_title: Column, path_titles: Column, base_url: Column, dom_first: Column) -> Column:
    """The best of up to eight candidates of three signs or more; on pages read from the live DOM, its summary or the sidebar first."""
    summary, description = endpoint["summary"], endpoint["description"]
    leaf, section, slug = title_from_path(path_titles), title_from_section(path_titles), S.slug_from_url(url, base_url)
    live = S.trim(summary)
    first = F.when((live != "") & ~live.rlike(BAD_TITLE) & ~S.is_placeholder(live), S.clean_sidebar_title(live)).otherwise(S.clean_sidebar_title(leaf))
    candidates = F.array(
        F.when((kind == "endpoint") & (summary != "") & ~S.trim(summary).rlike(BAD_TITLE) & ~S.is_placeholder(summary), summary), leaf, F.when(~section.eqNullSafe(leaf), section),
        F.when(nav_title != "", S.clean_sidebar_title(_titled(nav_title))), F.when((description != "") & ~S.is_placeholder(description), description), F.when(~slug.isin("", "page"), S.humanize_slug(slug)),
        F.concat_ws(" ", endpoint["method"], endpoint["path"]), _titled(title),
    )
    return F.coalesce(F.when(F.coalesce(dom_first, F.lit(False)), first), F.get(F.filter(candidates, lambda c: F.length(c) > 2), F.lit(0)), title)


# quality


def sanitize_endpoint(endpoint: Column) -> Column:
    kept = lambda name: F.filter(endpoint[name], lambda p: ~S.is_placeholder(p["name"]))
    out = endpoint
    for name, value in {"summary": S.sanitize_text(endpoint["summary"]), "description": S.sanitize_text(endpoint["description"]), "bodyParams": kept("bodyParams"), "queryParams": kept("queryParams"), "headers": kept("headers")}.items():
        out = out.withField(name, value)
    return F.when(endpoint.isNotNull(), out)


def _any(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0)) > 0


def quality_issues(title: Column, content: Column, markdown: Column, kind: Column, endpoint: Column, code: Column, violations: Column) -> Column:
    is_endpoint = (kind == "endpoint") & endpoint.isNotNull()
    bad_params = F.exists(F.coalesce(endpoint["bodyParams"], F.array()), lambda p: S.is_placeholder(p["name"]) | S.is_placeholder(p["description"]))
    return F.array_compact(
        F.array(
            F.when(_any(violations), "dom_assertion_failed"), F.when(S.trim(title).rlike(BAD_TITLE), "bad_title"), F.when(S.has_placeholder(content) | S.has_placeholder(markdown), "placeholders"),
            F.when(is_endpoint & bad_params, "params_placeholder"), F.when(is_endpoint & endpoint["method"].isin("POST", "PUT", "PATCH") & ~_any(endpoint["bodyParams"]), "missing_body_params"),
            F.when(is_endpoint & ~_any(endpoint["responses"]) & endpoint["response"].isNull(), "no_responses"), F.when(is_endpoint & ~_any(endpoint["examples"]) & ~_any(code), "no_examples"),
        )
    )


def extraction_quality(issues: Column) -> Column:
    return F.when(F.size(issues) == 0, "complete").when(F.array_contains(issues, "bad_title") & F.array_contains(issues, "placeholders"), "failed").otherwise("partial")


def grade(score: Column, violations: Column) -> Column:
    named = F.when(score >= 92, "excellent").when(score >= 78, "good").when(score >= 55, "partial").when(score >= 30, "poor").otherwise("broken")
    return F.when(_any(violations) & (named == "excellent"), "good").otherwise(named)


def quality_score(kind: Column, endpoint: Column, title: Column, code: Column, breadcrumbs: Column, live: Column, violations: Column) -> Column:
    """struct(score 0-100, grade, breakdown): weights 18/6/16/8/12/12/6/10/12 for endpoints, else 40/20/20/20."""
    named, crumbs = S.trim(title) != "", F.coalesce(F.size(breadcrumbs), F.lit(0))
    live = F.coalesce(live, F.lit(False))
    parts_endpoint = {
        "method_path": (18, (endpoint["method"] != "") & (endpoint["path"] != "")), "summary": (6, (S.trim(endpoint["summary"]) != "") | named), "body_params": (16, _any(endpoint["bodyParams"]) | (endpoint["method"] == "GET")),
        "headers": (8, _any(endpoint["headers"])), "responses": (12, _any(endpoint["responses"])), "examples": (12, _any(endpoint["examples"]) | _any(code)), "breadcrumbs": (6, crumbs >= 2), "dom_signals": (10, live), "assertions_clean": (12, ~_any(violations)),
    }
    parts_page = {"content": (40, named & (F.coalesce(F.size(code), F.lit(0)) + crumbs > 0)), "breadcrumbs": (20, crumbs >= 1), "signals": (20, live), "assertions": (20, ~_any(violations))}

    def scored(parts):
        each = {k: F.when(F.coalesce(ok, F.lit(False)), w).otherwise(0) for k, (w, ok) in parts.items()}
        total = F.lit(0)
        for v in each.values():
            total = total + v
        breakdown = F.create_map(*[x for k, v in each.items() for x in (F.lit(k), v)])
        return F.struct(total.cast("int").alias("score"), grade(total, violations).alias("grade"), breakdown.alias("breakdown"))

    return F.when((kind == "endpoint") & endpoint.isNotNull(), scored(parts_endpoint)).otherwise(scored(parts_page))


# live DOM snapshots


def snapshot_violations(dom: Column) -> Column:
    """What the live page showed but extraction left empty."""
    seen = dom["sectionVisibility"]
    return F.array_compact(
        F.array(
            F.when(seen["bodyParamsHeading"] & dom["method"].isin("POST", "PUT", "PATCH") & ~_any(dom["bodyParams"]), "body_params_section_visible_but_empty"),
            F.when((seen["tryItTablistCount"] >= 2) & ~_any(dom["tryItSamples"]), "try_it_tabs_present_but_no_samples"), F.when(seen["responsesUi"] & ~_any(dom["responses"]), "responses_ui_visible_but_empty"),
            F.when(seen["headersHeading"] & ~_any(dom["headers"]), "headers_section_visible_but_empty"), F.when(seen["queryParamsHeading"] & ~_any(dom["queryParams"]), "query_params_section_visible_but_empty"),
        )
    )


def _mentions_auth(headers: Column, samples: Column) -> Column:
    return F.exists(F.coalesce(headers, F.array()), lambda h: h["name"].rlike("(?i)authorization")) | F.exists(F.coalesce(samples, F.array()), lambda e: e["code"].rlike("(?i)authorization"))


def _as_params(params: Column) -> Column:
    from docloom.schemas import PARAM

    return F.transform(params, lambda p: F.struct(p["name"].alias("name"), p["type"].alias("type"), p["required"].alias("required"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("default"), p["in"].alias("in")).cast(PARAM))


def endpoint_from_snapshot(dom: Column) -> Column:
    """The endpoint as the live page has it; null without method or path."""
    from docloom.schemas import ENDPOINT

    out = F.struct(
        dom["method"].alias("method"), dom["path"].alias("path"), F.coalesce(dom["summary"], dom["pageTitle"]).alias("summary"), dom["description"].alias("description"), dom["headers"].alias("headers"), dom["queryParams"].alias("queryParams"),
        _as_params(S.path_params(dom["path"])).alias("pathParams"), dom["bodyParams"].alias("bodyParams"), F.lit(None).cast("string").alias("request"), F.lit(None).cast("string").alias("response"), dom["responses"].alias("responses"),
        _mentions_auth(dom["headers"], dom["tryItSamples"]).alias("authRequired"), dom["tryItSamples"].alias("examples"), F.expr("cast(array() as array<string>)").alias("tags"),
    )
    return F.when((dom["method"] != "") & (dom["path"] != ""), out.cast(ENDPOINT))


def merge_endpoint(static: Column, dom: Column) -> Column:
    """A static endpoint completed by a snapshot: lists of the snapshot where it has any, the longer description, examples by language."""
    either = lambda name: F.when(_any(dom[name]), dom[name]).otherwise(static[name])
    longer = F.when(F.length(dom["description"]) > F.coalesce(F.length(static["description"]), F.lit(0)), dom["description"]).otherwise(static["description"])
    server = S.blank_as_null(dom["serverUrl"])
    based = F.concat(F.lit("Base URL: "), server)
    described = F.when(server.isNull(), longer).when(F.coalesce(longer, F.lit("")) == "", based).when(~F.contains(longer, server), F.concat(longer, F.lit("\n\n"), based)).otherwise(longer)
    live = F.filter(F.coalesce(dom["tryItSamples"], static["examples"]), lambda e: S.trim(e["code"]) != "")
    # of the snapshot's samples the last of a language stands, at the place of the first
    languages = F.transform(live, lambda e: e["language"])
    last = F.transform(F.array_distinct(languages), lambda lang: F.element_at(F.filter(live, lambda e: e["language"] == lang), -1))
    examples = F.concat(last, S.first_by(F.filter(F.coalesce(static["examples"], live), lambda e: ~F.array_contains(languages, e["language"])), lambda e: e["language"]))
    path = F.coalesce(dom["path"], static["path"])
    out = static
    values = {
        "method": F.coalesce(dom["method"], static["method"]), "path": path, "summary": F.coalesce(dom["summary"], static["summary"]), "description": described, "bodyParams": either("bodyParams"), "headers": either("headers"),
        "queryParams": either("queryParams"), "responses": either("responses"), "examples": examples, "pathParams": F.when(path.rlike(r"\{[\w.-]+\}"), _as_params(S.path_params(path))).otherwise(static["pathParams"]),
        "authRequired": static["authRequired"] | _mentions_auth(either("headers"), dom["tryItSamples"]),
    }
    for name, value in values.items():
        out = out.withField(name, value)
    return F.when(static.isNull(), endpoint_from_snapshot(dom)).otherwise(out)


# stored documents


def document_problem(schema_columns: list[str]) -> Column:
    """Why a stored document isn't valid; null if it is."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("id", "title", "domain", "subcategory", "type", "content", "markdown", "headings", "tables", "examples", "codeBlocks", "breadcrumbs", "tags", "contentHash") if c in schema_columns]
    return F.coalesce(*missing, F.when(~S.is_url(F.col("url")), F.lit("url")), F.lit(None).cast("string"))


def chunk_is_valid(content: Column, url: Column) -> Column:
    return F.coalesce((F.length(content) >= 1) & S.is_url(url), F.lit(False))


def stored_id(raw_id: Column, filename: Column, hashed: Column) -> Column:
    return F.coalesce(S.blank_as_null(raw_id), S.id_from_filename(filename), hashed, F.lit("unknown"))
