"""DuckDB spellings of the scalar functions, for the SQL that checks the queries."""

from __future__ import annotations


def trim(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def chain(x, *steps):
    for pattern, new in steps:
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return x


def ws(x):
    return trim(chain(f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(9), '  ')", ("\\n{3,}", "\\n\\n".replace("\\n", "' || chr(10) || '")), ("[ \\t]+\\n", "' || chr(10) || '")))


def plain(x):
    first = f"regexp_replace({x}, '(?m)^---[\\s\\S]*?---\\n', '')"
    return trim(chain(first, ("```[\\s\\S]*?```", ""), ("`[^`]+`", ""), ("\\[([^\\]]+)\\]\\([^)]+\\)", "\\1"), ("[#*_~>-]", ""), ("\\s+", " ")))


def tokens(x):
    return f"CAST(ceil(len(regexp_split_to_array({plain(x)}, '\\s+')) * 1.3) AS INTEGER)"


def slug(x):
    return chain(trim(f"lower(strip_accents({x}))"), ("[^\\w\\s-]", ""), ("[\\s_]+", "-"), ("-+", "-"), ("^-|-$", ""))


def safe_slug(x, most=60):
    s = slug(x)
    return f"(CASE WHEN {s} = '' THEN 'page' WHEN length({s}) <= {most} THEN {s} ELSE coalesce(nullif(regexp_replace(left({s}, {most}), '-+$', ''), ''), 'page') END)"


def url_hash(x):
    return f"left(md5({x}), 12)"


def content_hash(x):
    return f"left(sha256({x}), 16)"


def url_path(x):
    return f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def url_host(x):
    return f"lower(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"


def origin(x):
    return f"regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def encoded(x):
    return f"array_to_string(list_transform(string_split({x}, ''), lambda c: CASE WHEN regexp_matches(c, '^[!-~]$') AND c NOT IN ('\"', '<', '>', '`') THEN c ELSE url_encode(c) END), '')"


def norm_url(x):
    """Of a URL with lower-case host and no default port."""
    bare = f"regexp_replace({x}, '#[\\s\\S]*', '')"
    return f"regexp_replace({origin(bare)} || {encoded(f'substr({bare}, length({origin(bare)}) + 1)')}, '/$', '')"


def segments(x):
    return f"list_filter(string_split({url_path(x)}, '/'), lambda s: s <> '')"


def url_slug(x):
    return f"(CASE WHEN len({segments(x)}) = 0 THEN 'index' ELSE {safe_slug(f'{segments(x)}[-1]')} END)"


def url_domain(x):
    return f"(CASE WHEN len({segments(x)}) = 0 THEN 'general' ELSE {safe_slug(f'{segments(x)}[1]', 48)} END)"


def placeholder(x):
    return f"regexp_matches({x}, '(?i)retrieving recent requests|loadingloading|^loading\\.{{0,3}}$|^retrieving|^please wait')"


def is_placeholder(x):
    return f"(coalesce(length({x}) < 2, true) OR {placeholder(trim(x))})"


def unescape(x):
    return f"replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


def h1(x="html"):
    return unescape(f"regexp_extract({x}, '<h1>([\\s\\S]*?)</h1>', 1)")


def capitalised(x):
    return f"array_to_string(list_transform(string_split({x}, '-'), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


def title_bad(x):
    return f"regexp_matches({trim(x)}, '(?i)^(200\\s*ok?|200|loading|untitled|page)$')"


def page_type(title, url):
    return f"""(CASE WHEN regexp_matches({title} || ' ' || {url}, '(?i)webhook|webhooks|callback(\\s|-)?url') THEN 'webhook'
 WHEN regexp_matches({url}, '(?i)/oauth|/openid|/token|/authorize|authentication|autentica(c|ç)ão|login|password\\s*grant') OR regexp_matches({title}, '(?i)\\b(auth|oauth|token)\\b') THEN 'auth'
 WHEN regexp_matches({title} || {url}, '(?i)overview|sobre|introduction|introdução|getting started') THEN 'overview' WHEN regexp_matches({title}, '(?i)schema|model|object') THEN 'schema'
 WHEN regexp_matches({title}, '(?i)guide|tutorial|how to') THEN 'guide' WHEN regexp_matches({title}, '(?i)changelog|release') THEN 'changelog' ELSE 'concept' END)"""


def should_crawl(url, base):
    return f"""({url_host(url)} = {url_host(base)} AND regexp_matches({url}, '(?i)^https?://') AND NOT regexp_matches({url}, '(?i)logout|signout|sign-out|\\.(png|jpg|jpeg|gif|svg|ico|woff2?|ttf|eot|css|js|map)(\\?|$)|#$|^mailto:|^tel:|javascript:')
 AND NOT regexp_matches({url_path(url)}, '(?i)/(logout|signout|sign-out|login)(\\?|$|/)'))"""


#: Links of the fixture pages: every one is a list item of the page's nav.
LINKS = f"""(SELECT page_id, page_url, i, title, regexp_replace({origin("page_url")} || {encoded("href")}, '#[\\s\\S]*', '') AS url, href FROM (
  SELECT page_id, page_url, i, {unescape("regexp_extract(m, '<a href=\"([^\"]*)\">', 1)")} AS href, {trim(unescape("regexp_extract(m, '<a href=\"[^\"]*\">([\\s\\S]*?)</a>', 1)"))} AS title FROM (
    SELECT page_id, url AS page_url, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="[^"]*">[\\s\\S]*?</a></li>') AS ms FROM pages))) WHERE NOT starts_with(href, '#'))"""


def shown(x):
    """Text as markdown shows it: white space collapsed, signs escaped."""
    tidy = f"trim(regexp_replace({x}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"
    return chain(tidy, ("([\\\\*_`\\[\\]])", "\\\\\\1"), ("^(#{1,6} |[-+] |>|=+|~~~)", "\\\\\\1"), ("^(\\d+)\\. ", "\\1\\\\. "))


#: Paragraphs of the fixture pages: a <b> that is never closed goes on in all later ones, three deep at most.
PARAGRAPHS = f"""(SELECT page_id, i, repeat('**', b + least(3, coalesce(sum(b) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INTEGER) AS mark, said FROM (
  SELECT page_id, i, starts_with(p, '<b>')::INTEGER AS b, {unescape("regexp_replace(p, '<b>|</p>|<br>$', '', 'g')")} AS said FROM (
    SELECT page_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (
      SELECT page_id, string_split(regexp_extract(html, '<article>[\\s\\S]*?</h1>([\\s\\S]*?)</article>', 1), '<p>') AS ps FROM pages)) WHERE i > 1))"""

_SLUG_TITLE = capitalised("regexp_replace(slug, '(?i)^(get|post|put|patch|delete)-', '')")

#: Documents of the fixture pages, by patterns instead of a tree.
DOCUMENTS = f"""(SELECT *, concat_ws(chr(10), nullif(page_title, ''), nullif(first, ''), markdown) AS content, CASE WHEN slug NOT IN ('', 'page') AND length({_SLUG_TITLE}) > 2 THEN {_SLUG_TITLE} ELSE page_title END AS title FROM (
  SELECT page_id, url, {trim(h1())} AS page_title, '# ' || {shown(h1())} || coalesce(chr(10) || chr(10) || body, '') AS markdown, coalesce(first, '') AS first,
    {url_domain("url")} AS domain, {safe_slug(url_slug("url"), 48)} AS subcategory, {url_slug("url")} AS slug, {page_type(h1(), "url")} AS type
  FROM pages LEFT JOIN (SELECT page_id, string_agg(mark || {shown("said")} || mark, chr(10) || chr(10) ORDER BY i) AS body, left(arg_min({trim("said")}, i), 500) AS first FROM {PARAGRAPHS} GROUP BY page_id) USING (page_id)))"""
