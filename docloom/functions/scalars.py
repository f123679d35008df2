"""Scalar functions over identity, text, slugs, URLs, paths and fingerprints, as Column expressions.

Everything here stays in the JVM.  Null inputs give null unless a function
says otherwise.  White space is the full Unicode set, as in the web platform.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the web platform's regular expressions.
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
SOLID = r"[^\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

HTTP_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")


def _accents() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter and combining marks, and those bases."""
    found = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        parts = [c for c in unicodedata.normalize("NFD", chr(code)) if not 0x300 <= ord(c) <= 0x36F]
        if len(parts) == 1 and parts[0] != chr(code):
            found[chr(code)] = parts[0]
    return "".join(found), "".join(found.values())


_ACCENTED, _BASE = _accents()


def trim(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def blank_as_null(c: Column) -> Column:
    """Empty strings count as absent, as in ``a || b``."""
    return F.nullif(c, F.lit(""))


# identity


def url_hash(c: Column) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, 12)


def content_hash(c: Column) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, 16)


# text


def strip_html(c: Column) -> Column:
    for pattern, new in ((r"(?i)<script[\s\S]*?</script>", ""), (r"(?i)<style[\s\S]*?</style>", ""), ("<[^>]+>", " "), (f"{SPACE}+", " ")):
        c = F.regexp_replace(c, pattern, new)
    return trim(c)


def normalize_whitespace(c: Column) -> Column:
    for pattern, new in (("\r\n", "\n"), ("\t", "  "), ("\n{3,}", "\n\n"), ("[ \t]+\n", "\n")):
        c = F.regexp_replace(c, pattern, new)
    return trim(c)


def truncate(c: Column, most: int) -> Column:
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, most - 3), F.lit("...")))


def is_empty_content(c: Column) -> Column:
    return F.length(strip_html(c)) < 20


def plain_text(markdown: Column) -> Column:
    """Markdown without front matter, code, link targets and marker signs, white space collapsed."""
    c = first_replaced(markdown, r"(?m)^---[\s\S]*?---\n")
    for pattern, new in ((r"```[\s\S]*?```", ""), ("`[^`]+`", ""), (r"\[([^\]]+)\]\([^)]+\)", "$1"), ("[#*_~>-]", ""), (f"{SPACE}+", " ")):
        c = F.regexp_replace(c, pattern, new)
    return trim(c)


def first_replaced(c: Column, pattern: str, new: str = "") -> Column:
    """Only the first match replaced."""
    at = F.regexp_instr(c, F.lit(pattern))
    found = F.regexp_substr(c, F.lit(pattern))
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.lit(new), F.substring(c, at + F.length(found), F.length(c)))).otherwise(c)


def word_count(text: Column) -> Column:
    """Pieces between white space; an empty text is one piece."""
    return F.size(F.split(text, f"{SPACE}+"))


def estimate_tokens(markdown: Column) -> Column:
    return F.ceil(word_count(plain_text(markdown)) * F.lit(1.3)).cast("int")


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


#: What counts as a secret in a log line.
SECRETS = (
    r"(?i)Bearer\s+[\w.-]+",
    r"(?i)token[=:]\s*[\"']?[\w.-]+",
    r"(?i)password[=:]\s*[\"']?[^\s\"']+",
    r"(?i)cookie[=:]\s*[\"']?[^\s\"']+",
    r"(?i)set-cookie",
    r"(?i)authorization[=:]\s*[\"']?[\w.-]+",
)


def redact_secrets(c: Column) -> Column:
    for pattern in SECRETS:
        c = F.regexp_replace(c, pattern, "[REDACTED]")
    return c


#: Header names whose values are hidden.
OPENAPI_SECRET_HEADERS = ("authorization", "cookie", "x-api-key", "x-auth-token")
GRAPHQL_SECRET_HEADERS = ("authorization", "cookie", "x-api-key")


def redact_headers(headers: Column, names: tuple[str, ...]) -> Column:
    hidden = lambda k: F.exists(F.array(*[F.lit(n) for n in names]), lambda n: F.contains(F.lower(k), n))
    return F.transform_values(headers, lambda k, v: F.when(hidden(k), F.lit("[REDACTED]")).otherwise(v))


# slugs


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _ACCENTED, _BASE), r"[\x{0300}-\x{036F}]", "")


def slugify(c: Column) -> Column:
    c = trim(F.lower(strip_accents(c)))
    for pattern, new in ((r"[^\w\s\x{00A0}-]", ""), (r"[\s\x{00A0}_]+", "-"), ("-+", "-"), (r"^-|-\z", "")):
        c = F.regexp_replace(c, pattern, new)
    return c


def safe_slug(c: Column, most: int = 60) -> Column:
    return safe_of(slugify(c), most)


def safe_of(slug: Column, most: int = 60) -> Column:
    """A slug made safe: never empty, at most so long."""
    slug = F.coalesce(slug, F.lit(""))
    cut = F.regexp_replace(F.substring(slug, 1, most), r"-+\z", "")
    return F.when(slug == "", "page").when(F.length(slug) <= most, slug).otherwise(F.coalesce(blank_as_null(cut), F.lit("page")))


def capitalised(slug: Column) -> Column:
    """Hyphenated words with their first letters in upper case, spaced."""
    return F.array_join(F.transform(F.split(slug, "-"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))), " ")


def domain_title(slug: Column) -> Column:
    """As capitalised; ``start`` and a ``v1-`` prefix are special."""
    return F.when(slug == "start", "Start").otherwise(capitalised(F.regexp_replace(slug, "^v1-", "")))


def humanize_slug(slug: Column) -> Column:
    return capitalised(F.regexp_replace(slug, "(?i)^(get|post|put|patch|delete)-", ""))


def clean_sidebar_title(title: Column) -> Column:
    spaced = trim(F.regexp_replace(title, r"(?i)([a-z])(post|get|put|patch|delete|head|options)\z", "$1 $2"))
    return F.coalesce(blank_as_null(trim(F.regexp_replace(spaced, r"(?i)(get|post|put|patch|delete|head|options)\z", ""))), title)


# URLs

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+"


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(_URL), F.lit(False))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), r":\d*\z", ""))


def url_origin(c: Column) -> Column:
    return F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def url_scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, no default port, a path of at least ``/``, blanks and non-ASCII signs percent-encoded."""
    scheme, host, rest = url_scheme(c), F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([\s\S]*)", 1)
    host = F.when(scheme == "http", F.regexp_replace(host, r":80\z", "")).when(scheme == "https", F.regexp_replace(host, r":443\z", "")).otherwise(host)
    rest = F.when(rest.rlike("^/"), rest).otherwise(F.concat(F.lit("/"), rest))
    signs = F.transform(F.regexp_extract_all(rest, F.lit(r"[\s\S]"), F.lit(0)), lambda x: F.when(x.rlike(r"[^\x21-\x7E]|[\"<>`]"), F.regexp_replace(F.url_encode(x), r"\+", "%20")).otherwise(x))
    encoded = F.when(rest.rlike(r"[^\x21-\x7E]|[\"<>`]"), F.array_join(signs, "")).otherwise(rest)
    return F.when(is_url(c), F.concat(scheme, F.lit("://"), host, encoded)).otherwise(c)


def normalize_url(c: Column, strip_invalid: bool = True) -> Column:
    """Canonical, without fragment and one trailing slash; what is no URL stays, with the slash gone if strip_invalid."""
    valid = F.regexp_replace(canonical_url(F.regexp_replace(c, r"#[\s\S]*", "")), r"/\z", "")
    return F.when(is_url(c), valid).otherwise(F.regexp_replace(c, r"/\z", "") if strip_invalid else c)


def _segments(url: Column, base_url: Column) -> Column:
    path, base = url_path(url), F.regexp_replace(url_path(base_url), r"/\z", "")
    inner = F.when((base != "") & F.startswith(path, base), F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)
    return F.filter(F.split(inner, "/"), lambda s: s != "")


def slug_from_url(url: Column, base_url: Column) -> Column:
    s = _segments(url, base_url)
    return F.when(~is_url(url) | ~is_url(base_url), url_hash(url)).when(F.size(s) == 0, "index").otherwise(safe_slug(F.element_at(s, -1)))


def domain_from_url(url: Column, base_url: Column) -> Column:
    s = _segments(url, base_url)
    return F.when(~is_url(url) | ~is_url(base_url) | (F.size(s) == 0), "general").otherwise(safe_slug(F.get(s, F.lit(0)), 48))


def domain_from_path(segments: Column) -> Column:
    first = blank_as_null(F.get(segments, F.lit(0)))
    return F.when(first.isNull(), "general").otherwise(safe_slug(first, 48))


def domain_root_url(slug: Column, base_url: Column) -> Column:
    base = F.regexp_replace(base_url, r"/\z", "")
    return F.when(slug == "start", F.concat(base, F.lit("/reference/inicio"))).otherwise(F.concat(base, F.lit("/"), slug, F.lit("/reference")))


def is_domain_root(url: Column) -> Column:
    return is_url(url) & (url_path(url).rlike(r"(?i)/reference/?\z") | url_path(url).rlike(r"(?i)/reference/inicio/?\z"))


def resolve_href(href: Column, page_url: Column) -> Column:
    """An absolute URL for a link: absolute, scheme-relative, root-relative, query or path-relative; null where it can't be one."""
    origin = url_origin(page_url)
    folder = F.regexp_replace(url_path(page_url), r"[^/]*\z", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    joined = F.concat(folder, href)
    for _ in range(4):
        joined = F.regexp_replace(F.regexp_replace(joined, r"/\./", "/"), r"/(?!\.\./)[^/?#]+/\.\./", "/")
    absolute = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(url_scheme(page_url), F.lit(":"), href)).when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, url_path(page_url), href)).otherwise(F.concat(origin, joined))
    )
    return F.when(is_url(absolute), canonical_url(absolute))


# file names and paths


def document_filename(url: Column, title: Column, base_url: Column, path: Column, method: Column, doc_id: Column) -> Column:
    """A readable name with the document's id: by endpoint, else URL slug, else title, else hash."""
    suffix = F.concat(F.lit("-"), F.coalesce(blank_as_null(doc_id), url_hash(url)))
    part = safe_slug(F.regexp_replace(F.regexp_replace(F.regexp_replace(path, "^/", ""), "/", "-"), "[{}]", ""), 60)
    by_endpoint = F.when((F.coalesce(method, F.lit("")) != "") & (F.coalesce(path, F.lit("")) != ""), safe_slug(F.concat(F.lower(method), F.lit("-"), part), 72))
    slug, label = slug_from_url(url, base_url), safe_slug(title, 40)
    base = F.coalesce(by_endpoint, F.when(~slug.isin("", "index", "page", "inicio"), slug), F.when(~label.isin("", "untitled", "page", "200"), label), url_hash(url))
    whole = F.concat(base, suffix)
    return F.when(F.length(whole) <= 100, F.concat(whole, F.lit(".md"))).otherwise(F.concat(url_hash(url), suffix, F.lit(".md")))


def _in_folder(kind: str, domain: Column, segments: Column, name: Column) -> Column:
    inner = F.filter(F.transform(segments, lambda s: safe_slug(s, 80)), lambda s: s != "")
    return F.concat_ws("/", F.lit(kind), safe_slug(domain, 80), inner, name)


def json_path(domain: Column, filename: Column, segments: Column) -> Column:
    base = F.when(F.endswith(filename, F.lit(".json")), F.regexp_replace(filename, r"\.json\z", "")).otherwise(F.regexp_replace(filename, r"\.md\z", ""))
    return _in_folder("json", domain, segments, F.concat(safe_slug(base, 120), F.lit(".json")))


def markdown_path(domain: Column, filename: Column, segments: Column) -> Column:
    base = F.when(F.endswith(filename, F.lit(".md")), F.regexp_replace(filename, r"\.md\z", "")).otherwise(F.regexp_replace(filename, r"\.json\z", ""))
    return _in_folder("markdown", domain, segments, F.concat(safe_slug(base, 120), F.lit(".md")))


def raw_html_path(domain: Column, file_id: Column) -> Column:
    return F.concat_ws("/", F.lit("raw-html"), safe_slug(domain, 80), F.concat(F.when(F.length(file_id) <= 24, file_id).otherwise(url_hash(file_id)), F.lit(".html")))


def chunk_path(domain: Column, chunk_id: Column) -> Column:
    return F.concat_ws("/", F.lit("chunks"), safe_slug(domain, 80), F.concat(F.substring(F.regexp_replace(chunk_id, "[^a-zA-Z0-9_-]", ""), 1, 32), F.lit(".json")))


def relative_path(path: Column, root: str) -> Column:
    return F.regexp_replace(path, f"^{root}/", "")


def id_from_filename(name: Column) -> Column:
    return blank_as_null(F.regexp_extract(name, r"(?i)-([a-f0-9]{12})\.json\z", 1))


# placeholders

#: Texts a page shows while it is loading.
PLACEHOLDERS = (r"(?i)retrieving recent requests", r"(?i)loadingloading", r"(?i)^loading\.{0,3}\z", r"(?i)^retrieving", r"(?i)^please wait")


def has_placeholder(c: Column) -> Column:
    out = F.lit(False)
    for p in PLACEHOLDERS:
        out = out | c.rlike(p)
    return F.coalesce(out, F.lit(False))


def is_placeholder(c: Column) -> Column:
    """Null and texts under two signs are placeholders too."""
    return F.coalesce(F.length(c) < 2, F.lit(True)) | has_placeholder(trim(c))


def sanitize_text(c: Column) -> Column:
    return F.when(~is_placeholder(c), trim(c))


# fingerprints


def fingerprint_text(c: Column) -> Column:
    return F.lower(trim(F.regexp_replace(c, f"{SPACE}+", " ")))


def _digest(parts: list[Column], most: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"), 256), 1, most)


def fingerprint_param(p: Column) -> Column:
    return _digest([p["in"], fingerprint_text(p["name"]), p["type"], F.substring(fingerprint_text(p["description"]), 1, 200)], 20)


def fingerprint_response(r: Column) -> Column:
    return _digest([r["statusCode"], F.substring(fingerprint_text(r["description"]), 1, 240)], 16)


def fingerprint_code(b: Column) -> Column:
    return _digest([F.coalesce(b["exampleType"], F.lit("snippet")), b["language"], b["label"], F.substring(fingerprint_text(b["code"]), 1, 400)], 20)


def let(value: Column, use) -> Column:
    """use(value) with value made once: inside a lambda an expression is made anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_by(items: Column, key) -> Column:
    """The items whose key no earlier item has; those of a null key are left out."""
    keyed = lambda xs: F.array_sort(F.transform(xs, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"))))
    firsts = lambda s: F.filter(s, lambda e, j: e["k"].isNotNull() & ((j == 0) | ~F.get(s, j - 1)["k"].eqNullSafe(e["k"])))
    return let(items, lambda xs: F.transform(F.array_sort(F.transform(let(keyed(xs), firsts), lambda e: e["i"])), lambda i: F.get(xs, i)))


def dedupe_params(items: Column) -> Column:
    return first_by(items, fingerprint_param)


def dedupe_responses(items: Column) -> Column:
    return F.array_sort(first_by(items, fingerprint_response), lambda a, b: F.when(a["statusCode"] < b["statusCode"], -1).when(a["statusCode"] > b["statusCode"], 1).otherwise(0))


def dedupe_code(items: Column) -> Column:
    return first_by(items, fingerprint_code)


def dedupe_samples(items: Column) -> Column:
    """Try-it samples: by language and snippet hash, or the code's beginning where there is no hash."""
    return first_by(items, lambda s: F.concat(F.coalesce(s["language"], F.lit("")), F.lit(":"), F.coalesce(s["snippetHash"], F.substring(s["code"], 1, 120))))


# path parameters


def path_param_type(name: Column) -> Column:
    low = F.lower(name)
    return F.when(F.contains(low, F.lit("uuid")) | F.endswith(low, F.lit("id")), "string").when(low.rlike("count|offset|limit|page"), "integer")


def path_params(path: Column) -> Column:
    """The placeholders of a template in order, each once, with a type guessed from the name."""
    names = F.array_distinct(F.regexp_extract_all(path, F.lit(r"\{([\w.-]+)\}"), F.lit(1)))
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(True).alias("required"), F.lit("path").alias("in"), path_param_type(n).alias("type")))


def path_params_static(path: Column) -> Column:
    """As the page parser has them: repeated, untyped, plain word names only."""
    return F.transform(F.regexp_extract_all(path, F.lit(r"\{(\w+)\}"), F.lit(1)), lambda n: F.struct(n.alias("name"), F.lit(True).alias("required"), F.lit("path").alias("in"), F.lit(None).cast("string").alias("type")))


# tables


def tables_markdown(tables: Column) -> Column:
    """Pipe tables, captions in bold above; rows are padded or cut to the headers, tables without any row are left out."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | ", ""), F.lit(" |"))

    def one(t):
        own = F.size(t["headers"]) > 0
        head = F.when(own, t["headers"]).otherwise(F.coalesce(F.get(t["rows"], F.lit(0)), F.slice(t["headers"], 1, 0)))
        body = F.when(own, t["rows"]).otherwise(F.slice(t["rows"], 2, F.greatest(F.size(t["rows"]) - 1, F.lit(0))))
        padded = lambda r: F.transform(head, lambda h, i: F.coalesce(F.get(r, i), F.lit("")))
        caption = F.when(F.coalesce(t["caption"], F.lit("")) != "", F.array(F.concat(F.lit("**"), t["caption"], F.lit("**\n")))).otherwise(F.expr("cast(array() as array<string>)"))
        lines = F.concat(caption, F.array(line(head), line(F.transform(head, lambda h: F.lit("---")))), F.transform(body, lambda r: line(padded(r))))
        return F.when(F.size(head) > 0, F.array_join(lines, "\n"))

    return F.array_join(F.array_compact(F.transform(tables, one)), "\n\n")


# code


def code_language(code: Column) -> Column:
    c = trim(code)
    return (
        F.when(c.rlike(r"^[{\[]"), "json").when(c.rlike("^<"), "xml").when(c.rlike(r"(?i)^(curl|wget)\s"), "bash").when(c.rlike(r"(?m)^(GET|POST|PUT|PATCH|DELETE)\s+/"), "http")
        .when(c.rlike(r"(?m)^(import|export|const|let|function|class)\s"), "typescript").when(c.rlike(r"(?m)^def\s|^import\s+\w+$"), "python").otherwise("text")
    )


def sample_language(code: Column, tab: Column) -> Column:
    """The language of a try-it sample, from its code or else its tab's name."""
    return (
        F.when(code.rlike(r"(?i)^curl\b"), "bash").when(code.rlike(r"(?i)^<\?php"), "php").when(code.rlike(r"(?m)^import |^const |^let |^require\("), "javascript")
        .when(code.rlike("(?m)^def |^import [a-z]"), "python").otherwise(F.regexp_replace(F.lower(tab), f"{SPACE}+", "-"))
    )


def requires_auth(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?i)auth(orization|enticat)|bearer|api[- ]?key|oauth|token required"), F.lit(False))


# front matter


def _quoted(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}: "), F.to_json(F.struct(value.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(value.alias("v")))) - 6))


def frontmatter(fields: dict[str, Column], auth: Column, tags: Column) -> Column:
    """The header block; null fields are left out, tags are a list."""
    lines = [F.when(v.isNotNull(), _quoted(k, v)) for k, v in fields.items() if k in ("domain", "subcategory", "title", "type", "method", "path")]
    lines.append(F.when(auth.isNotNull(), F.concat(F.lit("auth_required: "), auth.cast("string"))))
    lines += [F.when(v.isNotNull(), _quoted(k, v)) for k, v in fields.items() if k == "version"]
    lines.append(F.when(tags.isNotNull(), F.array_join(F.concat(F.array(F.lit("tags:")), F.transform(tags, lambda t: F.concat(F.lit("  - "), t))), "\n")))
    lines += [F.when(v.isNotNull(), _quoted(k, v)) for k, v in fields.items() if k in ("url", "id")]
    return F.concat(F.concat_ws("\n", F.lit("---"), *lines, F.lit("---")), F.lit("\n"))


def frontmatter_field(markdown: Column, key: str) -> Column:
    """One scalar field of a header block, unquoted; null if absent."""
    block = F.regexp_extract(markdown, r"^---\n([\s\S]*?)\n---", 1)
    value = F.regexp_extract(block, rf"(?m)^{key}:[ \t]*(\S.*)$", 1)
    return blank_as_null(F.regexp_replace(value, "^[\"']|[\"']$", ""))


def frontmatter_tags(markdown: Column) -> Column:
    block = F.regexp_extract(markdown, r"^---\n([\s\S]*?)\n---", 1)
    items = F.regexp_extract(block, r"(?m)^tags:\s*\n((?:\s+-\s+.+(?:\n|$))*)", 1)
    return F.transform(F.regexp_extract_all(items, F.lit(r"(?m)^\s+-\s+(.+)$"), F.lit(1)), lambda t: F.regexp_replace(t, "^[\"']|[\"']$", ""))


def with_badge(markdown: Column, method: Column, path: Column) -> Column:
    badge = F.concat(F.lit("**"), method, F.lit("** `"), path, F.lit("`\n\n"), markdown)
    return F.when(method.isNull() | path.isNull() | F.contains(markdown, path), markdown).otherwise(badge)


def retry_wait(delay_ms: Column, attempt: Column, factor: float = 2.0) -> Column:
    return delay_ms * F.pow(F.lit(factor), attempt - 1)
