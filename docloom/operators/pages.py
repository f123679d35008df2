"""The page parser: one pass over a page's tree gives every part that later operators need.

``extract`` is plain Python; ``parse_pages`` runs it over Arrow batches.  All
else about documents is done on its columns in the JVM.
"""

from __future__ import annotations

import json
import re
from urllib.parse import quote, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docloom import schemas
from docloom.functions import rules
from docloom.functions import scalars as S
from docloom.operators import htmltree as H

METHODS = S.HTTP_METHODS

#: Where a framework's pages keep their parts.
SELECTORS = {
    "readme": {
        "sidebar": ['[data-testid="sidebar"]', ".rm-Sidebar", 'nav[class*="Sidebar"]', ".Sidebar", "#sidebar", "aside nav"],
        "main": ['[data-testid="RDMD"]', ".rm-Article", "article.rm-Article", ".markdown-body", "main article", '[role="main"] article'],
        "title": ["h1", ".rm-Article h1", '[data-testid="page-title"]'],
        "crumbs": [".rm-Breadcrumbs", 'nav[aria-label="breadcrumb"]', ".breadcrumb"],
        "remove": [".rm-Sidebar", ".rm-Header", "header", "footer", ".rm-Feedback", '[data-testid="footer"]', ".search-bar", "#hub-search", ".rm-PageThumbs", ".rm-SuggestEdits"],
        "links": [".rm-Sidebar a[href]", "nav a[href]", '[data-testid="sidebar"] a[href]'],
    },
    "docusaurus": {
        "sidebar": [".theme-doc-sidebar-container", ".menu", "nav.menu"], "main": ["article", "main .markdown", ".theme-doc-markdown"], "title": ["h1", "header h1"],
        "crumbs": [".breadcrumbs", 'nav[aria-label="Breadcrumbs"]'], "remove": ["nav", "footer", ".theme-doc-sidebar-container", ".navbar"], "links": [".menu__link", ".theme-doc-sidebar-menu a"],
    },
    "mintlify": {
        "sidebar": ["#sidebar", "nav#navigation", '[class*="sidebar"]'], "main": ["#content-area", "article", "main"], "title": ["h1"], "crumbs": ['[class*="breadcrumb"]'],
        "remove": ["#sidebar", "footer", "header", "#navbar"], "links": ["#sidebar a", "nav a[href]"],
    },
    "redoc": {"sidebar": [".menu-content", "nav"], "main": [".redoc-wrap", '[role="main"]'], "title": ["h1"], "crumbs": [], "remove": ["nav", "footer"], "links": [".menu-content a"]},
    "swagger-ui": {"sidebar": [".sidebar", ".opblock-tag-section"], "main": [".swagger-ui", "#swagger-ui"], "title": ["h2", ".title"], "crumbs": [], "remove": [".topbar"], "links": [".opblock-tag a", "a[href]"]},
    "stoplight": {"sidebar": ['[class*="Sidebar"]', "nav"], "main": ['[class*="Article"]', "main"], "title": ["h1"], "crumbs": [], "remove": ["nav", "footer", "header"], "links": ["nav a[href]"]},
    "gitbook": {"sidebar": ['[data-testid="toc"]', "aside nav"], "main": ["main", "article"], "title": ["h1"], "crumbs": [], "remove": ["aside", "footer", "header"], "links": ["aside a[href]"]},
    "unknown": {
        "sidebar": ["nav", "aside", '[role="navigation"]'], "main": ["main", "article", '[role="main"]', ".content"], "title": ["h1"], "crumbs": ['nav[aria-label*="breadcrumb" i]'],
        "remove": ["nav", "footer", "header", "aside", ".sidebar"], "links": ["nav a[href]", "aside a[href]"],
    },
}
SIDEBAR_LINKS = '[data-testid="sidebar"] a[href], .rm-Sidebar a[href], nav.rm-Sidebar a[href], aside nav a[href]'
BADGES = (".rm-APIMethod", '[class*="HTTPMethod"]', '[class*="method-"]', ".api-method", ".http-verb", ".badge")
PATH_PLACES = (".rm-APIPath", '[class*="APIPath"]', '[class*="path"]', "code", "h1")
SECTION_TITLES = {"body": ("body params", "body parameters", "corpo"), "header": ("headers", "cabeçalho"), "query": ("query params", "query parameters", "parâmetros de consulta")}
TABLE_WORDS = {"header": ("header", "cabeçalho"), "query": ("query", "parâmetro", "parameter", "param"), "body": ("body", "request", "corpo", "payload")}
STATUS_PHRASES = ((r"(?i)^OK$", "200"), (r"(?i)bad request", "400"), (r"(?i)forbidden", "403"), (r"(?i)not found", "404"))

_METHOD = re.compile(rf"\b({'|'.join(METHODS)})\b", re.I | re.A)
_PATH = re.compile(r"""(?:^|\s|["'`])(/[\w{}/.:_-]+)""", re.A)
_LOADING = re.compile(r"loadingloading|^loading$", re.I)
_STATUS_TITLE = re.compile(r"^200\s*ok?$", re.I)

PARSED = (
    f"framework string, title string, description string, headings array<{schemas.HEADING}>, breadcrumbs array<string>, markdown string, tables array<{schemas.TABLE}>, code array<{schemas.EXAMPLE}>, "
    f"schema_blocks array<{schemas.EXAMPLE}>, endpoint {schemas.ENDPOINT}, links array<string>, sidebar_links array<string>, "
    "nav array<struct<title:string,slug:string,url:string,domain:string,depth:int,order:int,parentSlug:string,navPath:array<string>,pathTitles:array<string>>>"
)


def tidy(text: str) -> str:
    text = text.replace("\r\n", "\n").replace("\t", "  ")
    return re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", text)).strip()


def slug(text: str) -> str:
    import unicodedata

    low = "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F).lower().strip()
    return re.sub(r"^-|-$", "", re.sub(r"-+", "-", re.sub(r"[\s_]+", "-", re.sub(r"[^A-Za-z0-9_\s-]", "", low))))


def absolute(href: str | None, base: str) -> str | None:
    """href against base with blanks and non-ASCII signs encoded; null if it can't be a URL."""
    if not href or href.startswith("#") or href.lower().startswith("javascript:"):
        return None
    try:
        url = urljoin(base, href.strip())
        parts = urlsplit(url)
    except ValueError:
        return None
    if not parts.scheme or parts.scheme in ("http", "https") and not parts.netloc:
        return None
    return quote(url, safe=":/?#[]@!$&'()*+,;=%~-._|^{}\\") if "/" in url.split("://", 1)[-1] or not parts.netloc else quote(url, safe=":/?#[]@!$&'()*+,;=%~-._|^{}\\") + "/"


def _text(node: H.Node | None) -> str:
    return tidy(node.text()) if node is not None else ""


def _first(root: H.Node, selectors: list[str]) -> H.Node | None:
    for s in selectors:
        if (found := root.first(s)) is not None:
            return found
    return root.first("body")


def _heading_before(node: H.Node, tags: tuple[str, ...]) -> str:
    return next((n.text() for n in node.before() if n.tag in tags), "")


def _content(root: H.Node, sel: dict) -> dict:
    for s in sel["remove"]:
        for n in root.all(s):
            n.remove()
    main = _first(root, sel["main"])
    crumbs: list[str] = []
    for s in sel["crumbs"]:
        for box in root.all(s):
            for n in box.all("a, span, li"):
                if (t := _text(n)) and t not in crumbs:
                    crumbs.append(t)
        if crumbs:
            break
    heads = [{"level": int(n.tag[1]), "text": _text(n), "id": n.attrs.get("id")} for n in main.all("h1, h2, h3, h4, h5, h6")]
    para = main.first("p")
    return {"title": _text(_first(root, sel["title"])) or "Untitled", "description": _text(para)[:500] if para is not None else "", "headings": heads, "breadcrumbs": crumbs, "markdown": H.markdown(main)}


def tables_of(root: H.Node) -> list[dict]:
    out = []
    for table in root.all("table"):
        headers = [_text(n) for n in table.walk() if n.tag == "th" and (any(a.tag == "thead" for a in n.ancestors()) or n.parent.tag == "tr" and n.parent.parent.elements()[0] is n.parent)]
        body = [r for b in table.all("tbody") for r in b.all("tr")] or table.all("tr")[1 if headers else 0 :]
        rows = [cells for r in body if any(cells := [_text(c) for c in r.all("td, th")])]
        if not headers and rows:
            out.append({"headers": rows[0], "rows": rows[1:], "caption": None})
        elif headers or rows:
            caption = table.first("caption")
            out.append({"headers": headers, "rows": rows, "caption": (caption.text().strip() if caption else "") or None})
    return out


def guess_language(code: str) -> str:
    c = code.strip()
    for lang, hit in (
        ("json", c[:1] in ("{", "[")), ("xml", c[:1] == "<"), ("bash", re.match(r"(curl|wget)\s", c, re.I)), ("http", re.search(r"^(GET|POST|PUT|PATCH|DELETE)\s+/", c, re.M)),
        ("typescript", re.search(r"^(import|export|const|let|function|class)\s", c, re.M)), ("python", re.search(r"^def\s|^import\s+\w+$", c, re.M)),
    ):
        if hit:
            return lang
    return "text"


def _example(language, code, label, kind):
    return {"language": language, "code": code, "label": label or None, "sourceTab": None, "snippetHash": None, "exampleType": kind}


def code_of(root: H.Node) -> list[dict]:
    out, seen = [], set()
    for n in root.all('pre code, pre, [class*="CodeBlock"]'):
        code = n.text().strip()
        if len(code) < 2 or code[:100] in seen:
            continue
        seen.add(code[:100])
        inner = n.first("code")
        named = re.search(r"language-(\w+)", n.attrs.get("class") or (inner.attrs.get("class", "") if inner else ""))
        near = n.before()[:1]
        label = near[0].text().strip() if near and H.matches(near[0], "h3, h4, p, .caption") else ""
        if not label and (box := H.closest(n, '[class*="example"]')) is not None and (h := box.first("h3, h4")) is not None:
            label = h.text().strip()
        out.append(_example(named[1] if named else guess_language(code), code, label, "snippet"))
    return out


def json_properties(value: dict, depth: int = 0) -> list[dict]:
    """The properties of a JSON Schema, or the keys and types of plain JSON, nested up to five deep."""
    if depth > 5:
        return []
    declared = value.get("properties")
    if declared and isinstance(declared, dict):
        needed = value.get("required") if isinstance(value.get("required"), list) else []
        text = lambda d, k: d[k] if isinstance(d, dict) and isinstance(d.get(k), str) else None
        return [{"name": k, "type": text(d, "type"), "required": k in needed, "description": text(d, "description")} for k, d in declared.items()]
    kinds = {bool: "boolean", int: "number", float: "number", str: "string"}
    out = []
    for k, v in value.items():
        if isinstance(v, dict):
            out.append({"name": k, "type": "object", "required": False, "nested": {"name": k, "type": "object", "properties": json_properties(v, depth + 1)}})
        else:
            out.append({"name": k, "type": kinds.get(type(v), "object"), "required": False})
    return out


def schemas_of(root: H.Node) -> list[dict]:
    out = []
    for n in root.all("pre code, pre"):
        raw = n.text().strip()
        if raw[:1] not in ("{", "["):
            continue
        try:
            value = json.loads(raw)
        except ValueError:
            continue
        box = H.closest(n, '[class*="schema"]')
        inner = box.first("h3, h4") if box is not None else None
        name = _heading_before(n, ("h2", "h3", "h4")).strip() or (inner.text().strip() if inner else "") or "Schema"
        listed = {str(i): v for i, v in enumerate(value)} if isinstance(value, list) else value
        out.append({"name": tidy(name) or "Schema", "type": "array" if isinstance(value, list) else "object", "properties": json_properties(listed), "raw": raw})
    for table in root.all("table"):
        head = _heading_before(table, ("h2", "h3"))
        if not re.search("schema|model|object", head.lower()):
            continue
        props = []
        for r in table.all("tbody tr"):
            c = [_text(x) for x in r.all("td")]
            if len(c) >= 2:
                p = {"name": c[0], "type": c[1], "required": bool(len(c) > 2 and re.search("yes|sim|true|required", c[2], re.I))}
                props.append(p | ({"description": c[3]} if len(c) > 3 else {}))
        if props:
            out.append({"name": tidy(head) or "TableSchema", "type": "object", "properties": props, "raw": json.dumps(props, ensure_ascii=False, separators=(",", ":"))})
    return out


# endpoints


def _method(root: H.Node, text: str) -> str | None:
    for s in BADGES:
        n = root.first(s)
        if n is not None and (badge := n.text().strip().upper()) in METHODS:
            return badge
    found = _METHOD.findall(text)
    return found[min(1, len(found) - 1)].upper() if found else None


def _server(root: H.Node) -> H.Node | None:
    return root.first('[data-testid="serverurl"]')


def _path(root: H.Node, text: str) -> str | None:
    server = _server(root)
    named = (server.attrs.get("title") if "title" in server.attrs else server.text()) if server is not None else ""
    if named:
        try:
            parts = urlsplit(named.strip())
        except ValueError:
            parts = None
        if parts is not None and parts.scheme and parts.netloc:
            return quote(parts.path, safe="!$%&'()*+,-./:;=@[]^_|~") or "/"
        if m := _PATH.search(named):
            return m[1]
    for s in PATH_PLACES:
        if (n := root.first(s)) is not None and (m := _PATH.search(n.text().strip())):
            return m[1]
    m = _PATH.search(text)
    return m[1] if m else None


def _server_url(root: H.Node) -> str | None:
    n = _server(root)
    if n is None:
        return None
    if (t := n.attrs.get("title", "").strip()).startswith("http"):
        return re.sub(r"<!--\s*-->", "", t)
    text = _text(n)
    return text.split()[0] if text.startswith("http") else None


def _summary(root: H.Node) -> str | None:
    title = root.first("title")
    if title is not None and (t := title.text().strip()) and not re.fullmatch("readme", t, re.I):
        return tidy(t)
    for s, fits in ((".rm-APIHeader-title, .rm-APIHeader h1, [class*=\"APIHeader\"] h1, .rm-ReferenceMain .rm-APIMethod-heading", lambda x: not _STATUS_TITLE.match(x)), (".rm-APIPath, [class*=\"APIPath\"]", lambda x: x.startswith("/"))):
        if (t := _text(root.first(s))) and fits(t):
            return t
    return _text(root.first("h1")) or None


def _description(root: H.Node) -> str | None:
    parts = []
    box = root.first('.rm-APIHeader .rm-Markdown, .excerptT2m-MzSJGRK7 .rm-Markdown, header .rm-Markdown[data-testid="RDMD"]')
    if box is not None:
        parts += [t for p in box.all("p") if (t := _text(p)) and not _STATUS_TITLE.match(t)]
    parts += [t for q in root.all("header .rm-Markdown blockquote, .rm-APIHeader blockquote") if (t := _text(q))]
    if parts:
        return "\n\n".join(parts)
    meta = root.first('meta[name="description"]')
    if meta is not None and len(t := tidy(meta.attrs.get("content", ""))) > 20:
        return t
    return _text(root.first("article p, main p, .rm-Article p")) or None


def _param(name, kind, required, description, where, default=None):
    return {"name": name, "type": kind or None, "required": required, "description": description, "default": default or None, "in": where}


def _field_params(root: H.Node, where: str) -> list[dict]:
    box = None
    for h in root.all('[class*="APISectionHeader-heading"]'):
        label = _text(h).lower()
        if any(label.startswith(t) for t in SECTION_TITLES[where]):
            head = H.closest(h, "header")
            box = next((n for n in head.after() if H.matches(n, ".rm-ParamContainer")), None) if head is not None else None
            if box is not None:
                break
    out: dict[str, dict] = {}
    for field in box.all(".form-group.field") if box is not None else ():
        if field.first('[class*="Param-header"], [class*="Param-name"]') is None:
            continue
        entry, label = field.first("input[id], select[id], textarea[id]"), field.first('label[class*="Param-name"]')
        ident = entry.attrs["id"] if entry is not None else label.attrs.get("for") if label is not None else None
        name = ident.split("_")[-1] if ident else ""
        name = name or _text(field.first('[class*="Param-name"]'))
        if not name or re.search("retrieving|loadingloading|^loading$", name, re.I) or name in out:
            continue
        entry = field.first("input")
        out[name] = _param(name, _text(field.first('[class*="Param-type"]')), field.first('[class*="Param-required"]') is not None, _text(field.first(".Param-description p, .field-description p")) or None, where, entry.attrs.get("placeholder") if entry is not None else None)
    return list(out.values())


def _table_params(root: H.Node, where: str) -> list[dict]:
    out = []
    for table in root.all("table"):
        head = _heading_before(table, ("h2", "h3", "h4")).lower()
        if where != "body" and not any(w in head for w in TABLE_WORDS[where]):
            continue
        top = [n for n in table.walk() if n.tag in ("th", "td") and (n.tag == "th" and any(a.tag == "thead" for a in n.ancestors()) or n.parent.tag == "tr" and n.parent.parent.elements()[0] is n.parent)]
        names = [n.text().lower().strip() for n in top]
        place = lambda *ws: next((i for i, h in enumerate(names) if any(w in h for w in ws)), -1)
        name_at, type_at, need_at, desc_at = place("name", "campo", "field"), place("type", "tipo"), place("required", "obrigat"), place("desc")
        for r in table.all("tbody tr"):
            c = [_text(x) for x in r.all("td")]
            cell = lambda i: c[i] if 0 <= i < len(c) else None  # noqa: B023, E731
            name = cell(max(name_at, 0))
            if not name or re.search("retrieving recent requests|loading", name, re.I):
                continue
            out.append(_param(name, cell(type_at), bool(need_at >= 0 and re.search("yes|sim|true|required|obrigat", cell(need_at) or "", re.I)), cell(desc_at), where))
    return out


def _picker_responses(root: H.Node) -> list[dict]:
    out: dict[str, dict] = {}
    for option in root.all('[class*="APIResponseSchemaPicker-option"]'):
        codes = [a for n in option.all("[aria-label]") if re.fullmatch(r"\d{3}", a := n.attrs["aria-label"].strip())]
        label = tidy("".join(n.text() for n in option.all('[class*="APIResponseSchemaPicker-label"]')))
        said = tidy("".join(n.text() for n in option.all('[class*="APIResponseSchemaPicker-description"]'))) or label
        code = codes[-1] if codes else (m[1] if (m := re.search(r"\b(\d{3})\b", label)) else next((c for p, c in STATUS_PHRASES if re.search(p, said)), None))
        if code and code not in out:
            out[code] = {"statusCode": code, "description": said or None, "schema": None, "example": None}
    return [out[c] for c in sorted(out)]


def _table_responses(root: H.Node) -> list[dict]:
    out = []
    for table in root.all("table"):
        head = _heading_before(table, ("h2", "h3")).lower()
        if "response" in head or "resposta" in head:
            for r in table.all("tbody tr"):
                if c := [x.text().strip() for x in r.all("td")]:
                    out.append({"statusCode": c[0], "description": c[1] if len(c) > 1 else None, "schema": None, "example": c[2] if len(c) > 2 else None})
    return out


def _json_example(root: H.Node, words: tuple[str, ...]) -> str | None:
    found = None
    for n in root.all("pre code, pre"):
        text = n.text().strip()
        if text.startswith("{") or any(w in _heading_before(n, ("h2", "h3", "h4")).lower() for w in words):
            try:
                found = json.dumps(json.loads(text), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                pass
    return found


def _best_example(root: H.Node) -> list[dict]:
    best = None
    for pre in root.all("pre"):
        inner = pre.first("code")
        code = "".join(n.text() for n in pre.all("code")) or pre.text()
        code = re.sub(r"x{6,}\d*", "", code).replace("\\n", "\n").strip()
        if not code or _LOADING.search(code):
            continue
        named = re.search(r"language-(\w+)", inner.attrs.get("class", "")) if inner is not None else None
        lang = named[1] if named else "bash" if re.search(r"curl|request\s+(GET|POST|PUT|PATCH|DELETE)", code, re.I) else "text"
        score = len(code) + 500 * bool(re.search(r"curl\s+--request", code, re.I)) + 300 * bool(re.search(r"--url\s+https?://", code, re.I)) + 100 * bool(re.search("Authorization", code, re.I))
        if best is None or score > best[0]:
            best = (score, _example(lang, code, "Try It", None))
    return [best[1]] if best else []


def endpoint_of(root: H.Node, markdown: str) -> dict | None:
    text = f"{_text(root.first('body'))}\n{markdown}"
    method = _method(root, text)
    path = _path(root, text) if method else None
    if not path:
        return None
    headers = _field_params(root, "header") or _table_params(root, "header")
    server, described = _server_url(root), _description(root)
    if server and (not described or server not in described):
        described = f"{described}\n\nBase URL: {server}" if described else f"Base URL: {server}"
    return {
        "method": method, "path": path, "summary": _summary(root), "description": described, "headers": headers, "queryParams": _field_params(root, "query") or _table_params(root, "query"),
        "pathParams": [_param(n, None, True, None, "path") for n in re.findall(r"\{(\w+)\}", path, re.A)], "bodyParams": _field_params(root, "body") or _table_params(root, "body"),
        "request": _json_example(root, ("request", "body", "payload")), "response": _json_example(root, ("response", "resposta")), "responses": _picker_responses(root) or _table_responses(root),
        "authRequired": bool(re.search(r"auth(orization|enticat)|bearer|api[- ]?key|oauth|token required", text, re.I)) or any(re.search("auth", h["name"], re.I) for h in headers), "examples": _best_example(root), "tags": [],
    }


# links and sidebar


def links_of(root: H.Node, base: str, selectors: str, strip: bool) -> list[str]:
    host, out = urlsplit(base).hostname, {}
    for n in root.all(selectors):
        url = absolute(n.attrs.get("href"), base)
        if url and urlsplit(url).hostname == host:
            url = url.split("#")[0]
            out[url[:-1] if strip and url.endswith("/") else url] = None
    return list(out)


def _nav_item(li: H.Node, base: str, depth: int, order: int) -> dict | None:
    link = li.first('> a, > div a, [class*="link"] a')
    named = li.first('[class*="title"], [class*="label"]')
    title = tidy((link.text() if link is not None else "") or (named.text() if named is not None else "") or li.text())
    if len(title) < 2:
        return None
    below = li.elements("ul", "ol")[:1]
    return {"title": title, "url": absolute(link.attrs.get("href"), base) if link is not None else None, "depth": depth, "order": order, "children": _nav_list(below[0], base, depth + 1) if below else []}


def _nav_list(box: H.Node, base: str, depth: int) -> list[dict]:
    lists = box.elements("ul", "ol")
    items = [li for x in lists for li in x.elements("li")] if lists else box.elements("li")
    if not items:
        return [x for i, n in enumerate(box.all('[class*="item"], [class*="Item"]')) if (x := _nav_item(n, base, depth, i))]
    out = [x for i, li in enumerate(items) if (x := _nav_item(li, base, depth, i))]
    if out:
        return out
    for i, a in enumerate(box.all("a[href]")):
        title = tidy(a.text())
        if len(title) >= 2:
            li = H.closest(a, "li")
            below = li.elements("ul", "ol")[:1] if li is not None else []
            out.append({"title": title, "url": absolute(a.attrs["href"], base), "depth": depth, "order": i, "children": _nav_list(below[0], base, depth + 1) if below else []})
    return out


def nav_of(root: H.Node, base: str, selectors: list[str]) -> list[dict]:
    """Sidebar entries with a URL, depth first; of root entries with one slug the last stands, at the first one's place."""
    box = next((n for s in selectors if (n := root.first(s)) is not None), None) or root.first("nav")
    if box is None:
        return []
    roots = {slug(x["title"]): x for x in _nav_list(box, base, 0)}
    out: list[dict] = []

    def add(x, domain, path, titles, parent):
        path, titles = [*path, slug(x["title"])], [*titles, x["title"]]
        if x["url"]:
            out.append({"title": x["title"], "slug": path[-1], "url": x["url"], "domain": domain, "depth": x["depth"] if parent else 0, "order": x["order"] if parent else 0, "parentSlug": parent, "navPath": path, "pathTitles": titles})
        for c in x["children"]:
            add(c, domain, path, titles, path[-1])

    for s, x in roots.items():
        add(x, s, [], [], None)
    return out


#: The words that the frameworks' patterns are alternatives of, folded.
_FRAMEWORK_WORDS = sorted({re.sub(r"\\(.)", r"\1", w).casefold() for _, p in rules.FRAMEWORKS for w in p.removeprefix("(?i)").split("|")})


def framework_of(html: str) -> str:
    folded = html.casefold()
    if not any(w in folded for w in _FRAMEWORK_WORDS):
        return "unknown"
    return next((name for name, p in rules.FRAMEWORKS if re.search(p, html)), "unknown")


#: What can be read off a page without the rest.
LINK_PARTS = ("links", "sidebar_links", "nav")


def _link_part(name: str, root: H.Node, base: str, sel: dict) -> list:
    if name == "nav":
        return nav_of(root, base, sel["sidebar"])
    return links_of(root, base, SIDEBAR_LINKS, True) if name == "sidebar_links" else links_of(root, base, ", ".join([*sel["links"], "main a[href]", "article a[href]"]), False)


def extract(html: str | None, url: str | None) -> dict:
    """All parts of one page.  Null pages are empty ones."""
    html, base = html or "", url or "http://localhost/"
    fw = framework_of(html)
    sel = SELECTORS[fw]
    root = H.parse(html)
    out = {"framework": fw, "tables": tables_of(root), "code": code_of(root)} | {p: _link_part(p, root, base, sel) for p in LINK_PARTS}
    out["schema_blocks"] = [_example("json", s["raw"], s["name"], "schema") for s in schemas_of(root)]
    body_text_root = H.parse(html)
    out |= _content(root, sel)
    out["endpoint"] = endpoint_of(body_text_root, out["markdown"])
    return out


def extract_only(html: str | None, url: str | None, parts: tuple[str, ...]) -> dict:
    """Some of LINK_PARTS of one page, as extract gives them."""
    html, base = html or "", url or "http://localhost/"
    root, sel = H.parse(html), SELECTORS[framework_of(html)]
    return {p: _link_part(p, root, base, sel) for p in parts}


def parse_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", only: tuple[str, ...] = ()) -> DataFrame:
    """(ord, url, parsed...) of raw pages; ord is the page id.  With only, some of LINK_PARTS, no other part is made."""
    from pyspark.sql.pandas.types import to_arrow_schema

    whole = StructType.fromDDL("ord long, url string, " + PARSED)
    if unknown := set(only) - set(LINK_PARTS):
        raise ValueError(f"not made alone: {sorted(unknown)}")
    wanted = StructType([f for f in whole if not only or f.name in ("ord", "url", *only)])
    schema = to_arrow_schema(wanted)

    def go(batches):
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch.slice(i, 200).to_pydict()
                rows = [{"ord": o, "url": u} | (extract_only(h, u, only) if only else extract(h, u)) for o, u, h in zip(part["ord"], part["url"], part["html"], strict=True)]
                yield from pa.Table.from_pylist(rows, schema=schema).to_batches()

    return pages.select(F.col(page_id).cast("long").alias("ord"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(go, wanted)


def crawl_links(parsed: DataFrame, base_url: Column, sidebar_first: bool = True) -> DataFrame:
    """parsed with followed: sidebar links where there are any, else page links, those worth a visit."""
    ok = lambda c: F.filter(c, lambda u: rules.should_crawl(u, base_url))
    side = ok(F.col("sidebar_links"))
    return parsed.withColumn("followed", F.when(F.lit(sidebar_first) & (F.size(side) > 0), side).otherwise(ok(F.col("links"))))


def documents(parsed: DataFrame, base_url: Column | None = None, nav: DataFrame | None = None) -> DataFrame:
    """Documents (the document schema plus ord) from parsed pages.

    parsed may have a column dom_snapshot; nav gives domain, breadcrumbs and
    title where a page's URL is in it.  base_url is by default each page's own
    origin.
    """
    from docloom.operators import navigation as N

    base = S.url_origin(F.col("url")) if base_url is None else base_url
    if "dom_snapshot" not in parsed.columns:
        parsed = parsed.withColumn("dom_snapshot", F.lit(None).cast(schemas.SNAPSHOT))
    if nav is None:
        parsed = parsed.withColumn("nav_row", F.lit(None).cast("struct<url:string,title:string,slug:string,domain:string,depth:int,order:int,parentSlug:string,navPath:array<string>,pathTitles:array<string>>"))
    else:
        index = N.crawl_index(nav).select("norm_url", F.struct("url", "title", "slug", "domain", "depth", "order", "parentSlug", "navPath", "pathTitles").alias("nav_row"))
        parsed = parsed.withColumn("norm_url", F.regexp_replace("url", r"/\z", "")).join(index, "norm_url", "left").drop("norm_url")
    dom, nav_row = F.col("dom_snapshot"), F.col("nav_row")
    primary = F.coalesce((dom["method"] != "") & (dom["path"] != ""), F.lit(False))
    domain, sub = N.resolve_domain(F.col("url"), base, nav_row)
    live_title = F.when((S.trim(dom["pageTitle"]) != "") & ~S.trim(dom["pageTitle"]).rlike(r"(?i)^(200\s*ok?|readme)\z"), dom["pageTitle"])
    d = parsed.select(
        "ord", "url", "framework", "markdown", "headings", "tables", "nav_row", "dom_snapshot", base.alias("base"), primary.alias("primary"), domain.alias("domain"), sub.alias("subcategory"),
        N.inner_segments(nav_row["navPath"]).alias("storageSegments"), F.coalesce(live_title, "title").alias("page_title"), F.when(F.length(dom["description"]) > F.length("description"), dom["description"]).otherwise(F.col("description")).alias("description"),
        F.when(F.size(dom["breadcrumbs"]) > 0, dom["breadcrumbs"]).when(F.size(nav_row["pathTitles"]) > 0, nav_row["pathTitles"]).otherwise(F.col("breadcrumbs")).alias("breadcrumbs"),
        rules.sanitize_endpoint(F.when(primary, rules.endpoint_from_snapshot(dom)).otherwise(F.col("endpoint"))).alias("endpoint"),
        F.coalesce(F.transform(dom["tryItSamples"], lambda s: s.withField("exampleType", F.lit("try-it"))), F.expr(f"cast(array() as array<{schemas.EXAMPLE}>)")).alias("samples"), F.when(primary, F.slice("code", 1, 0)).otherwise(F.col("code")).alias("code"), "schema_blocks",
    )
    loaded = lambda c: F.filter(c, lambda b: ~S.trim(b["code"]).rlike(r"(?i)loadingloading|^loading\z"))
    d = d.withColumn("type", rules.document_type(F.col("endpoint").isNotNull(), F.col("page_title"), F.col("url"))).withColumn("codeBlocks", S.dedupe_code(loaded(F.concat("samples", "code", "schema_blocks"))))
    d = d.withColumn("examples", F.when(F.col("primary"), loaded(F.col("samples"))).otherwise(F.filter("codeBlocks", lambda b: F.contains(F.lower(b["label"]), F.lit("example")))))
    d = d.withColumn("content", F.concat_ws("\n", *[S.blank_as_null(F.col(c)) for c in ("page_title", "description", "markdown")]))
    signals = F.struct(
        F.lit(True).alias("domExtraction"), F.col("primary").alias("domSourceOfTruth"), F.size(dom["bodyParams"]).alias("bodyParamCount"), F.size(dom["headers"]).alias("headerCount"), F.size(dom["responses"]).alias("responseCount"),
        F.size(dom["tryItSamples"]).alias("tryItLanguageCount"), F.when(F.size(rules.snapshot_violations(dom)) > 0, rules.snapshot_violations(dom)).alias("domViolations"),
    )
    d = d.withColumn("extractionSignals", F.when(dom.isNotNull(), signals))
    d = d.withColumn("title", rules.resolve_title(F.col("page_title"), F.col("type"), F.col("endpoint"), F.col("url"), nav_row["title"], nav_row["pathTitles"], F.col("base"), F.col("extractionSignals.domSourceOfTruth")))
    d = d.withColumn("description", F.coalesce(S.sanitize_text(F.col("description")), "description"))
    violations = F.col("extractionSignals.domViolations")
    d = d.withColumn("issues", rules.quality_issues(F.col("title"), F.col("content"), F.col("markdown"), F.col("type"), F.col("endpoint"), F.col("codeBlocks"), violations))
    score = rules.quality_score(F.col("type"), F.col("endpoint"), F.col("title"), F.col("codeBlocks"), F.col("breadcrumbs"), F.col("extractionSignals.domExtraction"), violations)
    return d.select(
        "ord", S.url_hash(F.col("url")).alias("id"), "title", "domain", "subcategory", "storageSegments", "type", "url", "content", "markdown", "description", "headings", "tables", "examples", "codeBlocks", "breadcrumbs",
        rules.tags(F.col("domain"), F.col("subcategory"), F.col("type"), F.col("endpoint.method")).alias("tags"), "endpoint", F.lit(None).cast("string").alias("version"), F.col("endpoint.authRequired").alias("authRequired"), S.content_hash(F.col("content")).alias("contentHash"),
        "framework", rules.extraction_quality(F.col("issues")).alias("extractionQuality"), "extractionSignals", score.alias("qualityScore"), "issues",
    )


def nav_rows(parsed: DataFrame) -> DataFrame:
    """Sidebar rows of all pages, in order of page and place."""
    rows = parsed.select("ord", F.posexplode("nav").alias("i", "n"))
    return rows.select("n.url", "n.title", "n.slug", "n.domain", "n.depth", "n.order", "n.parentSlug", "n.navPath", "n.pathTitles", (F.col("ord") * 1_000_000 + F.col("i")).alias("ord"))
