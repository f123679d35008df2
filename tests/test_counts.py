"""Counts and numbers where several pages share a URL."""

import pytest

from docloom.operators import chunks, pages
from docloom.plans import pipeline, queries

def _pages(spark, folder, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)

def test_health_of_pages_with_one_url(spark, tmp_path):
    d = _pages(spark, tmp_path, [(1, "https://h/a", "x"), (5, "https://h/a", "y"), (10, "https://h/b", "z"), (15, None, "v")])
    assert tuple(queries.health(spark, d).first()) == (4, 1, 3)


def test_rebuild_counts_of_pages_with_one_url(spark, tmp_path):
    d = _pages(spark, tmp_path, [(1, "https://h/a", "x"), (5, "https://h/a", "y"), (10, "https://h/b", "z"), (11, "https://h/c", "w")])
    assert tuple(queries.rebuild_counts(spark, d).first()) == (2, 2)


@pytest.mark.parametrize(("html", "want"), [("a&amp;&amp", "a&&amp"), ("a&ampb &lt;&lt", "a&ampb <&lt"), ("&#65;&#66 &#x43;&#x44", "A&#66 C&#x44"), ("﷐&amp", "﷐&amp"), ("A & B", "A & B")])
def test_references_without_semicolon_are_text(html, want):
    got = pages.extract(f'<h1>{html}</h1><ul><li><a href="/x?a=1&copy=2&amp;b">link</a></li></ul><main><a href="/x?a=1&copy=2&amp;b">l</a></main><script>a && b</script>', "https://h/")
    assert got["title"] == want and got["links"] == ["https://h/x?a=1&copy=2&b"]


def test_chunks_of_pages_with_one_url_are_numbered_through(spark):
    page = lambda i, url, word: (i, url, f"<html><body><main><h1>{word}</h1><p>{word} {'text ' * 9}</p></main></body></html>")
    raw = spark.createDataFrame([page(3, "https://h/a", "late"), page(1, "https://h/a", "early"), page(2, "https://h/b", "other")], "page_id long, url string, html string")
    got = sorted((c.sourceUrl, c.ordinal, c.section) for c in chunks.chunk_documents(pipeline.rebuild(raw)).collect())
    assert got == [("https://h/a", 0, "early"), ("https://h/a", 1, "late"), ("https://h/b", 0, "other")]


def test_ngram_join_keeps_only_what_its_result_reads(spark, monkeypatch):
    import os

    from docloom.llm import common, ngram_join

    words = [f"w{i}" for i in range(200)]
    rows = [(g * 100 + k, " ".join([f"g{g}x{w}" for w in words[k:]])) for g in range(3) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = None
    for bytes_at_once in (64 << 20, 0):  # all fragments at once, then one by one
        monkeypatch.setattr(ngram_join, "AT_ONCE", bytes_at_once)
        before = set(common._scratch)
        got = sorted(map(tuple, ngram_join.jaccard_components(docs).collect()))
        left = sorted(p.rpartition("/")[2].partition("-")[0] for p in common._scratch if p not in before and os.path.exists(p))
        assert left == ["counts", "edges"] and (want is None or got == want)
        want = got
    assert {r[3] for r in want} == {0, 100, 200}


def test_link_parts_alone_equal_the_whole_parse(spark, monkeypatch):
    from docloom.operators import htmltree
    from docloom.plans.queries import _HTML

    raw = spark.createDataFrame([(1, "https://h/users", _HTML), (2, "https://h/g", _HTML.replace("<aside>", '<aside class="rm-Sidebar">')), (3, None, None)], "page_id long, url string, html string")
    whole = {r.ord: r for r in pages.parse_pages(raw).collect()}
    assert whole[2].framework == "readme" and pages.framework_of("a README.io b") == "readme" and pages.framework_of("plain") == "unknown"
    for only in (("links",), ("nav",), ("links", "sidebar_links")):
        got = pages.parse_pages(raw, only=only)
        assert got.columns == ["ord", "url", *only]
        assert all([getattr(r, c) for c in only] == [getattr(whole[r.ord], c) for c in only] for r in got.collect())
    for name in ("tables_of", "code_of", "schemas_of", "endpoint_of", "_content"):  # none of these is needed for links
        monkeypatch.setattr(pages, name, None)
    assert pages.extract_only(_HTML, "https://h/users", ("links",))["links"] == whole[1].links
    root = htmltree.parse("<DIV class=a><p>x</p><a href=y>z</a></DIV>")
    assert [n.tag for n in root.all("P, div.a, *[href]")] == ["div", "p", "a"] and root.all("div > p, a > p") == root.all("p")


def test_first_by_makes_each_key_once(spark):
    import time

    from pyspark.sql import functions as F

    from docloom.functions import scalars as S

    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(5999)), lambda i: F.when(i != 7, F.concat(F.lit("k"), (i % 5000).cast("string")))).alias("xs"))
    began = time.time()
    got = df.select(S.first_by(F.col("xs"), lambda x: S.content_hash(x)).alias("x")).first().x
    assert got == [f"k{i}" for i in range(5000) if i != 7] + ["k7"] and time.time() - began < 15


def test_packed_paragraphs_with_signs_that_join(spark):
    from pyspark.sql import functions as F

    import math
    import random
    import re

    def plain(t):
        for p, new in ((r"```[\s\S]*?```", ""), ("`[^`]+`", ""), (r"\[([^\]]+)\]\([^)]+\)", r"\1"), ("[#*_~>-]", ""), (r"\s+", " ")):
            t = re.sub(p, new, t)
        return t.strip()

    rng, rows = random.Random(3), []
    for i in range(30):
        word = lambda: rng.choice(["plain", "words", "`open", "[a", "b](c)", "*x*", "code`"][: 2 if i % 2 else 7])  # noqa: B023, E731
        rows.append((str(i), "\n\n".join(" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(40))))
    got = spark.createDataFrame(rows, "id string, t string").select("id", chunks.packed(F.col("t"), 100, True).alias("c")).collect()
    for (_, text), r in zip(rows, sorted(got, key=lambda r: int(r.id)), strict=True):
        want, buffer = [], ""
        for p in (p for x in re.split(r"\n\n+", text) if len(p := plain(x)) > 20):
            both = f"{buffer}\n\n{p}"
            if buffer and math.ceil(len(re.split(r"\s+", plain(both))) * 1.3) > 100:
                want.append(buffer)
                buffer = p
            else:
                buffer = both if buffer else p
        assert r.c == want + ([buffer] if buffer else [])
