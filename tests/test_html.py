"""The page parser on hand-written cases."""

import json

import pytest

from docloom.operators import htmltree as H
from docloom.operators import pages as P
from docloom.plans.queries import _HTML


def md(html):
    return H.markdown(H.parse(html).first("body"))


def test_tree_repairs():
    root = H.parse("<p><b>one<br><p>two<script>var t='</p>';</script><ul><li>a<li>b</ul>")
    assert [n.text() for n in root.all("p")] == ["one", "two" + "var t='</p>';"]
    assert len(root.all("p b")) == 2 and [n.text() for n in root.all("li")] == ["a", "b"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<h2>A <em>b</em></h2><p>x<br>y</p>", "## A _b_\n\nx  \ny"),
        ("<ul><li>a</li><li>b<ul><li>c</li></ul></li></ul>", "-   a\n-   b\n    -   c"),
        ("<ol><li>a</li><li>b</li></ol>", "1.  a\n2.  b"),
        ("<pre><code class='language-js'>let a = 1\n</code></pre>", "```js\nlet a = 1\n```"),
        ("<p>a*b_c [d]</p>", "a\\*b\\_c \\[d\\]"),
        ("<p><a href='/x'>t</a> <code>k</code> <strong>s</strong></p>", "[t](/x) `k` **s**"),
        ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>", "| a | b |\n| --- | --- |\n| 1 | 2 |"),
        ("<blockquote><p>q</p></blockquote><hr>", "> q\n\n* * *"),
        ("", ""),
    ],
)
def test_markdown(html, want):
    assert md(html) == want


@pytest.mark.parametrize(("selector", "n"), [("main p", 1), ("#i", 1), (".c.d", 1), ('[data-x="1"]', 1), ('a[href^="/"]', 2), ("main > p", 1), ("body > p", 0), ('[class*="C" i]', 1), ("h1, a", 3), ("nav li > a", 2)])
def test_selectors(selector, n):
    root = H.parse('<main><h1 id=i>t</h1><p class="c d" data-x=1>x</p></main><nav><ul><li><a href="/a">a</a><li><a href="/b">b</a></ul></nav>')
    assert len(root.all(selector)) == n


def test_extract_everything():
    out = P.extract(_HTML, "https://h/users")
    assert out["title"] == "Create user" and out["framework"] == "unknown"
    e = out["endpoint"]
    assert (e["method"], e["path"], e["authRequired"]) == ("POST", "/users/{id}", True)
    assert [p["name"] for p in e["pathParams"]] == ["id"] and e["bodyParams"][0] == {"name": "name", "type": "string", "required": True, "description": "Full name", "default": None, "in": "body"}
    assert e["responses"] == [{"statusCode": "200", "description": "OK", "schema": None, "example": None}]
    assert e["examples"][0]["language"] == "bash" and e["examples"][0]["code"].startswith("curl")
    assert out["tables"][0] == {"headers": ["Name", "Type", "Required", "Description"], "rows": [["name", "string", "yes", "Full name"]], "caption": "Fields"}
    assert out["tables"][1] == {"headers": ["200", "OK"], "rows": [], "caption": None}
    assert [(n["slug"], n["navPath"], n["depth"]) for n in out["nav"]] == [("guide", ["guide"], 0), ("alpha", ["guide", "alpha"], 1), ("beta-page", ["guide", "beta-page"], 1), ("reference", ["reference"], 0)]
    named = {s["label"]: json.loads(s["code"]) for s in out["schema_blocks"]}
    assert named["User object"]["required"] == ["id"]


@pytest.mark.parametrize(("html", "name"), [("x readme.io", "readme"), ("docusaurus", "docusaurus"), ("mintlify", "mintlify"), ("redoc", "redoc"), ("swagger-ui", "swagger-ui"), ("stoplight", "stoplight"), ("gitbook", "gitbook"), ("README", "readme"), ("", "unknown")])
def test_frameworks(html, name):
    assert P.framework_of(html) == name


@pytest.mark.parametrize(("text", "method"), [("nothing", None), ("one get only", "GET"), ("get then post then put", "POST")])
def test_method_words(text, method):
    assert P._method(H.parse("<p>x</p>"), text) == method


def test_parameter_fields_and_responses():
    html = """<div class="rm-Article"><header class="x"><h3 class="APISectionHeader-heading1">Body Params</h3></header><div class="rm-ParamContainer">
    <div class="form-group field"><label class="Param-name1" for="a_b_name">name</label><span class="Param-type2">string</span><span class="Param-required3">required</span><div class="field-description"><p>Who</p></div><input id="body_name" placeholder="Ann"></div>
    <div class="form-group field"><label class="Param-name1">Loading</label></div></div>
    <div class="APIResponseSchemaPicker-option1"><span aria-label="404"></span><span class="APIResponseSchemaPicker-description1">Missing</span></div>
    <div class="APIResponseSchemaPicker-option1"><span class="APIResponseSchemaPicker-label1">200</span></div></div>"""
    root = H.parse(html)
    assert P._field_params(root, "body") == [{"name": "name", "type": "string", "required": True, "description": "Who", "default": "Ann", "in": "body"}]
    assert [r["statusCode"] for r in P._picker_responses(root)] == ["200", "404"]


def test_json_properties_nest_to_a_depth():
    deep = {"a": 1}
    for _ in range(9):
        deep = {"n": deep}
    out, depth = P.json_properties(deep), 0
    while out and "nested" in out[0]:
        out, depth = out[0]["nested"]["properties"], depth + 1
    assert depth == 6 and P.json_properties({"x": [1], "y": "s", "z": True})[0]["type"] == "object"


def test_null_page():
    out = P.extract(None, None)
    assert out["title"] == "Untitled" and out["markdown"] == "" and out["endpoint"] is None


def test_unclosed_formatting_is_reopened_three_deep_at_most():
    md = H.markdown(H.parse("<p><b>x" * 6 + "<p>y").first("body"))
    assert md.split("\n\n")[-1] == "******y******" and md.split("\n\n")[4] == "********x********"
