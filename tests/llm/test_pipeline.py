"""The pipeline's stages against brute force."""

import itertools
import re

import corpus_pipeline
from pyspark.sql import Row
from test_operators import brute_mix

from docloom.llm import queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_stages(spark, tmp_path):
    body = [" ".join(f"{'abcdefgh'[(i * 7 + j * j) % 8]}word{(i * 31 + j * j) % 97}" for j in range(60)) for i in range(12)]
    near = body[0].replace(body[0].split()[30], "other", 1)
    test_item = "this benchmark passage has more than ten words in it for sure"
    rows = [(i, t, "en", f"src{i % 3}", None) for i, t in enumerate(body)]
    rows += [(20, near, "en", "src0", None), (21, body[1], "en", "src1", None), (21, body[1], "en", "src1", None), (22, f"{body[2][:80]} {test_item} tail", "en", "src2", None), (23, None, None, None, None), (24, "12 34", None, "src1", None), (25, "", "en", "src1", None), (26, "short text", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as score", "'x' as cls", "2 as `copies`", "7 as gone_id", "8 as bad_key", "9 as twice", "'r' as `row`", "1 as id", "'b' as body", "0 as `key`", "0 as gone", "0 as bad", "'z' as lang_pred")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, test_item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = {}
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        before, at = at, spark.read.parquet(f"{tmp_path}/out{k}")
        seen[k] = [r.asDict() for r in at.collect()]
        if k < 4:
            assert at.columns == before.columns, name
    ids = lambda k: sorted(r["doc_id"] for r in seen[k])
    assert ids(0) == sorted(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    left = seen[0]
    sets = [shingles(r["text"], 5) for r in left]
    gone = {max(left[i]["doc_id"], left[j]["doc_id"]) for i, j in itertools.combinations(range(len(left)), 2) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert gone == {20, 21}
    assert ids(1) == sorted({r["doc_id"] for r in left} - gone)
    assert ids(2) == [i for i in ids(1) if i != 22]
    assert set(ids(3)) <= set(ids(2)) and max(ids(3).count(i) for i in ids(3)) <= 2
    n = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    number = lambda r: int(m[1]) if (m := re.match(r"^src([0-9]{1,6})$", r["source"] or "")) else 99
    domain = lambda r: "web" if number(r) <= 4 else "books" if number(r) <= 14 else "forum"
    taken = brute_mix([Row(**{c: r[c] for c in ("doc_id", "text", "lang", "source")}) for r in seen[2]], queries.mixture(1, 1), domain)
    assert {i: ids(3).count(i) for i in ids(2)} == {i: x[0][1] for i, x in taken.items()}
    assert n(seen[3]) <= 2 * n(seen[2])
    assert sorted(r["doc_id"] for r in seen[4]) == ids(3)
    total = 0
    for r in sorted(seen[4], key=lambda r: r["start"]):
        assert r["start"] == total
        total += r["n_tokens"]


def test_repeated_ids_keep_one_of_each_text(spark, tmp_path):
    rows = [(1, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon"), (2, "zeta eta theta iota kappa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source")
    out = corpus_pipeline._near_duplicates(spark, docs, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(set(rows)) and out.columns == docs.columns


def test_language_stage_without_a_model(spark, tmp_path):
    texts = ["plain words", "Größe", "слова", None, "", "12 34 !?", "a"]
    for lang in (None, "und"):
        docs = spark.createDataFrame([(i, t, lang, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
        out = corpus_pipeline._language(spark, docs, str(tmp_path))
        assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 6] and out.columns == docs.columns


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_operators_are_registered():
    assert sorted(int(m[1]) for q in queries.QUERIES if (m := re.match(r"op(\d+)_", q))) == list(range(1, 11))
