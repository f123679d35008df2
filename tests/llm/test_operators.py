"""The ten operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import itertools
import json
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import ann, bytekernel, chat, common, components, decontamination, grammar_output, language_id, licenses, mixing, ngram_join, quality, warc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, (text or "").translate(LOW))


def sample_texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünïcode", "mit", "license", "straße"]
    base = [" ".join(rng.choice(vocabulary, rng.integers(5, 120))) for _ in range(40)]
    near = [t.replace(t.split()[0], "changed", 1) for t in base[:10]]
    return [None, "", "  \n ", "one", "one two", "One TWO", "x" * 30_000, " ".join(base[:12]) + ".", *base, *near, *base[:5], base[0]]


def documents(spark, extra=()):
    texts = [*sample_texts(), *extra]
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}" if i % 7 else None, None) for i, t in enumerate(texts)]
    rows.append((3, "one", "en", "src3", None))  # a repeated row
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# kernel


def test_word_spans_and_hashes():
    import pyarrow as pa

    texts = ["Ab c-d", None, "", "É x", "a b a"]
    raw, off = bytekernel.text_bytes(pa.array(texts))
    s, e, first = bytekernel.word_spans(raw, off, bytekernel.ALNUM)
    got = [[raw[a:b].tobytes().decode() for a, b in zip(s[i:j], e[i:j])] for i, j in itertools.pairwise(first)]
    assert got == [["Ab", "c", "d"], [], [], ["É", "x"], ["a", "b", "a"]]
    h = bytekernel.span_hashes(raw, s, e)
    assert h[5] == h[7] and len(set(h.tolist())) == 7


def test_hash_index():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    index = bytekernel.HashIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), 1, -1) * 1).sum() >= 0
    assert (bytekernel.HashIndex(keys[:0]).find(keys) == -1).all()


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (4, 6), (7, 7), (3, 1), (9, 8)], "a long, b long")
    got = {r.id: r.component for r in components.components(edges).collect()}
    assert {k: v for k, v in got.items() if k != v} == {2: 1, 3: 1, 5: 4, 6: 4, 9: 8}
    assert components.components(edges.limit(0)).count() == 0


# 1


def brute_mix(rows, m, domain):
    leaves = {}
    for r in rows:
        key = (domain(r), r.lang or "(none)", r.source or "(none)")
        leaves.setdefault(key, []).append(r)
    n = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    cap = {k: sum(map(n, v)) * m.max_epochs for k, v in leaves.items()}

    def fill(nodes, above):
        out, left, live = {}, above, dict(nodes)
        while live:
            total = sum(w for w, _ in live.values())
            full = {k: c for k, (w, c) in live.items() if c * total <= left * w}
            if not full:
                return out | {k: left * w // total for k, (w, _) in live.items()}
            # all capped at once would overshoot what the smallest ratio leaves, so one at a time
            k = min(full, key=lambda k: (live[k][1] / live[k][0], k))
            out[k] = full[k]
            left -= full[k]
            del live[k]
        return out

    total = sum(cap.values()) // m.max_epochs * m.budget_num // m.budget_den
    cap_of = lambda *p: sum(c for k, c in cap.items() if k[: len(p)] == p)
    d = fill({k: (m.domains.get(k, 1), cap_of(k)) for k in {k[0] for k in cap}}, total)
    out = {}
    for a in d:
        lang = fill({k: (m.langs.get(k, 1), cap_of(a, k)) for k in {k[1] for k in cap if k[0] == a}}, d[a])
        for b in lang:
            src = fill({k: (m.sources.get(k, 1), cap[a, b, k]) for k in {k[2] for k in cap if k[:2] == (a, b)}}, lang[b])
            for c in src:
                t = cap[a, b, c] // m.max_epochs
                epochs, rest = divmod(src[c], t) if t else (0, 0)
                key = lambda r: hashlib.md5(f"{m.seed}:{epochs}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()  # noqa: B023, E731
                start = 0
                for _, group in itertools.groupby(sorted(leaves[a, b, c], key=key), key):
                    group = list(group)
                    for r in group:
                        out.setdefault(r.doc_id, []).append((src[c], epochs + (start < rest)))
                    start += sum(map(n, group))
    return out


def test_mixing(spark):
    m = mixing.Mixture("CASE WHEN source = 'src1' THEN 'a' ELSE 'b' END", {"a": 3}, {"en": 2, "de": 5}, {"src2": 4}, 7, 10, max_epochs=2)
    docs = documents(spark).withColumn("copies", F.lit("clash")).withColumn("key", F.lit(0))
    got = mixing.select(docs, m).collect()
    want = brute_mix(docs.collect(), m, lambda r: "a" if r.source == "src1" else "b")
    assert len(got) == docs.count()
    for r in got:
        assert (r.leaf_budget, r.copies) in want[r.doc_id]
    leaf = {}
    for r in got:
        leaf.setdefault((r.domain, r.lang, r.source), []).append(r)
    for rows in leaf.values():
        if len({r.doc_id for r in rows}) == len(rows):
            assert sum(r.tokens_taken for r in rows) == rows[0].leaf_budget
    full = mixing.mixed(docs, m)
    assert full.columns == docs.columns and full.count() == sum(r.copies for r in got)
    assert mixing.select(empty(spark), m).count() == 0


# 2


def test_ann_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((400, 32)).astype(np.float32)
    v[50:60] = v[50]  # copies, ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [1.0]), (None, v[0].tolist()), (904, [None] * 32)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    got = {}
    for r in ann.nearest(table, F.col("id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 400, 20))
    d = v.astype(np.float64)
    hit = 0
    for q, found in got.items():
        score = (d[q] * d).sum(1)
        want = sorted((i for i in range(400) if i != q), key=lambda i: (-score[i], i))[:20]
        found.sort()
        assert [r for r, *_ in found] == list(range(1, 21))
        hit += len(set(want) & {i for _, i, _ in found})
        for _, i, s in found:
            assert abs(s - score[i]) < 1e-9
    assert hit / (20 * len(got)) >= 0.99
    few = ann.nearest(table.where("vec_id < 5"), F.col("id") % 20 == 0, k=20)
    assert few.count() == 4
    assert ann.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_ann_recall_on_heavy_tails(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 32)
    rng = np.random.default_rng(55)
    v = rng.standard_t(2.5, (3000, 48)) * rng.lognormal(0, 1, (3000, 1))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in ann.nearest(table, F.col("id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(range(0, 3000, 20)) and all(len(x) == 20 for x in got.values())
    score = v @ v.T
    hit = sum(len(set(sorted((i for i in range(3000) if i != q), key=lambda i: -score[q, i])[:20]) & x) for q, x in got.items())
    assert hit / (20 * len(got)) >= 0.99


def test_ann_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.1, 3.0])]
    got = [tuple(r) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0, k=3).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 3.0), (0, 2, 1, 0.25), (0, 3, 1, 0.25)]  # asked by the smaller vector, (0, 1)


# 3


def test_grammar_round_trip():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 6, n) for n in (1, 2, 50, 3000, 1)] + [np.zeros(77, int), np.tile([1, 2, 3], 500)]
    ids = np.concatenate(docs).astype(np.uint16)
    start = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    symbols, sym_start, rules = grammar_output.compress(ids, start, 10)
    assert len(rules) and len(symbols) < len(ids) // 2
    length, _, _ = grammar_output.expansions(rules, 10)
    row = {"ids": np.arange(7).tobytes(), "id_nulls": np.zeros(7, bool).tobytes(), "sym_start": sym_start.astype(np.uint32).tobytes(), "tok_start": start.astype(np.uint32).tobytes(), "symbols": symbols.tobytes(), "lengths": length[10:].astype(np.uint32).tobytes(), "rules": rules.tobytes(), "base": 10}
    shard = grammar_output.Shard(row)
    assert (shard.all() == ids).all()
    for k, d in enumerate(docs):
        assert (shard.document(k) == d).all()
    assert (shard.tokens(3, 700, 1900) == docs[3][700:1900]).all()


def test_grammar_goes_on_while_pairs_are_frequent():
    doc = np.random.default_rng(5).integers(0, 300, 500).astype(np.uint16)
    ids, start = np.tile(doc, 1000), np.arange(1001) * 500
    symbols, sym_start, rules = grammar_output.compress(ids, start, 300)
    inner = np.ones(len(symbols) - 1, bool)
    inner[sym_start[1:-1] - 1] = False
    pairs = (symbols[:-1].astype(np.int64) << 16 | symbols[1:])[inner]
    assert not len(pairs) or np.unique(pairs, return_counts=True)[1].max() < grammar_output.LEAST
    assert len(symbols) == 1000
    length, at, pool = grammar_output.expansions(rules, 300)
    assert all((pool[at[x] : at[x] + length[x]] == doc).all() for x in np.unique(symbols))


def test_token_output(spark, tmp_path):
    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["it's we'll DON'T ''s", "a<|endoftext|>b", "naïve — “quotes” ½ ÀÉ×÷ 12three", "tab\tnew\r\nline\x0b\x0c", "\x01ctl", "漢字 кириллица", "a" * 400, "´`^~  x"]
    docs = documents(spark, odd).withColumn("part", F.lit(1))
    got = grammar_output.read_documents(spark, grammar_output.write_shards(docs, shard_tokens=2000)).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id, r.text or ""))
    start = 0
    for r, g in zip(rows, sorted(got, key=lambda g: (g.start, g.doc_id)), strict=True):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), r.text
        start += len(ids)
    assert grammar_output.read_documents(spark, grammar_output.write_shards(empty(spark))).count() == 0


# 4


def test_escape_is_reversible():
    rng = np.random.default_rng(4)
    parts = [*chat.CONTROL, "\\", "<", "[", "|>", "a", "<s", "INST]", "\n"]
    for _ in range(500):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        out = chat.escape(text)
        assert chat.unescape(out) == text
        assert not any(c in out for c in chat.CONTROL)


def test_chat(spark, monkeypatch):
    rows = [(1, 0, "user", "hi </s>[INST]"), (1, 1, "assistant", "ok \\ <|end|>"), (1, 2, "assistant", None), (2, 1, "assistant", "später"), (2, 0, None, ""), (3, 0, "assistant", "x" * 5000), (None, 0, "user", "n"), (4, 0, "user", "t"), (4, 0, "assistant", "t")]
    rows += [(5, i, ["user", "assistant"][i % 2], f"turn {i} <s>") for i in range(60)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(0))
    for most in (1 << 16, 40):
        monkeypatch.setattr(chat, "PART_TOKENS", most)
        got = {r.conv_id: r for r in chat.read_chats(spark, chat.write_chats(table)).collect()}
        for conv in {r[0] for r in rows}:
            turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or ""))
            text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
            loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
            g = got[conv]
            assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
            assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
            assert g.formatted_chars == sum(len(chat.escape(r[2] or "")) + len(chat.escape(r[3] or "")) + len("".join(chat.RESERVED)) for r in turns)
    assert chat.read_chats(spark, chat.write_chats(table.limit(0))).count() == 0


# 5


@pytest.mark.parametrize("budget", [1 << 24, 600])
def test_decontamination(spark, monkeypatch, budget):
    monkeypatch.setattr(decontamination, "TEST_BYTES", budget)
    docs = documents(spark).withColumn("items", F.lit("clash"))
    texts = [r.text for r in docs.collect()]
    items = [(1, texts[10]), (2, " ".join(texts[12].split()[3:16])), (3, "one two"), (4, None), (5, "..."), (10, texts[10]), (6, "w1")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(docs, tests, window=10).collect()
    assert len(got) == docs.count()
    found = {}
    for g in got:
        found.setdefault(g.doc_id, []).append(g)
    for r in docs.collect():
        w, hit, names = words(r.text), set(), set()
        for i, t in items:
            x = words(t)
            m = min(10, len(x))
            for j in range(len(x) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p : p + m] == x[j : j + m]:
                        hit |= set(range(p, p + m))
                        names.add(i)
        g = found[r.doc_id][0]
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        assert (g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) == (len(w), len(hit), len(names), digest, bool(hit)), r
    assert decontamination.contamination(empty(spark), tests).count() == 0
    assert decontamination.contamination(docs, tests.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("budget", [1 << 24, 60])
def test_decontamination_by_items_without_id(spark, monkeypatch, budget):
    monkeypatch.setattr(decontamination, "TEST_BYTES", budget)
    one, two = "alpha beta gamma delta epsilon zeta", "some other passage of seven words here"
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"{one} {two}"), (3, two), (4, "nothing")], "doc_id long, text string")
    tests = spark.createDataFrame([(None, one), (None, one + " y"), (0, two)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contamination(docs, tests, window=6).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {1: (7, 1, [], digest(""), True), 2: (13, 2, [0], digest("0"), True), 3: (7, 1, [0], digest("0"), True), 4: (0, 0, [], digest(""), False)}
    assert {k: (r.n_hit, r.n_items, r["items"], r.items_sha256, r.contaminated) for k, r in got.items()} == want


def test_proximity(spark):
    docs = documents(spark)
    index = decontamination.build_index(docs, block_words=200)
    rows = [(r.doc_id, r.position) for r in decontamination.proximity_hits(index, "w1 w2 W1", 3).collect()]
    got, near = set(rows), set()
    assert decontamination.proximity_hits(index, "", 3).count() == 0
    for r in docs.collect():
        w = words(r.text)
        near |= {(r.doc_id, i) for i, x in enumerate(w) if x == "w1" and "w2" in w[max(0, i - 3) : i + 4]}
    assert got == near


def test_decontamination_of_equal_blocks_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "TEST_BYTES", 300)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 7)
    passage = " ".join(f"p{i}" for i in range(60))
    text = f"before {passage} after"
    docs = spark.createDataFrame([(1, text)] * 4 + [(2, "none of it")] * 2, "doc_id long, text string").repartition(6)
    tests = spark.createDataFrame([(k, passage) for k in range(12)] + [(0, passage)], "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontamination.contamination(docs, tests).collect()]
    assert sorted(got) == [(1, 62, 60, 12)] * 4 + [(2, 3, 0, 0)] * 2


def test_decontamination_of_a_very_long_text(spark):
    filler = " ".join(f"f{i % 977}" for i in range(400_000))
    passage = "ten words that stand at the end of one long"
    docs = spark.createDataFrame([(1, f"{filler} {passage}"), (2, filler)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontamination.contamination(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()}
    assert got == {1: (400_010, 10), 2: (400_000, 0)}


# 6


def test_quality_learns_shape(spark):
    rng = np.random.default_rng(6)
    good = [" ".join(f"word{rng.integers(0, 300)}" for _ in range(rng.integers(20, 80))) + "." for _ in range(300)]
    bad = [" ".join(["spam!!"] * int(rng.integers(20, 80))) for _ in range(150)]
    texts = [None, "", *good, *bad]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 302), 0) for i in range(2, 452)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    held = [r for i, r in got.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r in held)
    assert np.mean([r.predicted == (r.doc_id < 302) for r in held if r.doc_id > 1]) > 0.95
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0


def brute_features(text):
    b = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
    raw = (text or "").encode()
    w, lines = re.findall(rb"[^\x20\x09-\x0d]+", b), re.findall(rb"[^\n]+", b)
    n, m = max(len(w), 1), max(len(lines), 1)
    size = max(sum(map(len, w)), 1)
    count = lambda signs: sum(raw.count(bytes([c])) for c in signs.encode())
    upper, lower = count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count("abcdefghijklmnopqrstuvwxyz")
    rare, distinct = "#$%&*+/<=>@[\\]^_`{|}~", len(set(w))
    return [
        np.log1p(len(w)), size / n * bool(w), upper / max(upper + lower, 1), count("0123456789") / size, count("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") / size, count(rare) / size,
        distinct / n, max(Counter(w).values(), default=0) / n, sum(x == y for x, y in itertools.pairwise(w)) / n, count("!") / n, 1 - len(set(lines)) / m if lines else 0, len(w) / m,
        sum(len(x) <= 3 for x in w) / n, sum(c >= 128 for c in raw) / size, count("|") / n, count(".!?") / n, sum(x[-1:].decode("latin1") in rare + "!" for x in w) / n, distinct / np.sqrt(n),
    ]


def test_quality_by_brute_force():
    texts = [*sample_texts(), "A!! b|c | d? \n\nsame line\nSame Line\n--x [y] é~", "word " * 300_000, "z" * 1_200_000]
    x = quality.features(bytekernel.pa.array(texts, bytekernel.pa.string()))
    assert np.allclose(x, [brute_features(t) for t in texts])
    rng = np.random.default_rng(66)
    x = rng.integers(0, 9, (500, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 3)).astype(float)
    model = quality.Additive().fit(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95  # which only a pair of features tells
    for row, got in zip(x[:50].tolist(), model.score(x[:50]), strict=True):
        z = model.base + sum(t[sum(c <= v for c in edges)] for v, edges, t in zip(row, model.edges, model.tables, strict=True))
        z += sum(t[sum(c <= row[i] for c in model.coarse[i]), sum(c <= row[j] for c in model.coarse[j])] for (i, j), t in zip(model.pairs, model.grids, strict=True))
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-12


def test_samples_of_huge_tables():
    assert common.share_below(20_000, 100) == common.share_below(20_000, 20_000) == 1 << 62
    for n in (10**6, 10**11, 10**14):
        assert abs(common.share_below(20_000, n) / 2**62 * n - 20_000) < 1


def test_quality_repeated_and_long_rows(spark):
    rows = [(1, "good words stand here " * 20), (1, "good words stand here " * 20), (2, "bad !! " * 20), (3, "bad !! " * 200_000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = sorted((r.doc_id, r.score) for r in quality.classify(docs, labels).collect())
    assert [i for i, _ in got] == [1, 1, 2, 3, 4] and got[0] == got[1] and all(0 <= s <= 1 for _, s in got)


# 7


def test_licenses(spark):
    extra = ["Released under the MIT License.", "MIT-LICENSE apache license, apache license; CC by", " ".join(["w"] * 70) + " This work is licensed under the GNU General Public License, version 3.", "Mit lIcense mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"]
    docs = documents(spark, extra).withColumn("label", F.lit("clash"))
    got = licenses.scan(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for g in got:
        by.setdefault(g.doc_id, []).append(g)
    sets = [(n, set(s)) for n, s in licenses.template_sets()]
    for r in docs.collect():
        w, hits = words(r.text), []
        for p, label in licenses.PHRASES.items():
            q = p.split()
            hits += [(i, label) for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
        best, more = 0.0, set()
        for k in range((max(len(w), 1) - 1) // licenses.STRIDE + 1):
            block = set(w[k * licenses.STRIDE : k * licenses.STRIDE + licenses.BLOCK])
            for name, s in sets:
                if len(block & s) >= -(-len(s) * licenses.NUM // licenses.DEN):
                    more.add(name)
                    best = max(best, len(block & s) / len(s))
        own = {x for _, x in hits}
        g = by[r.doc_id][0]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None)
        assert g.base_labels == ",".join(sorted(own)) and g.labels == ",".join(sorted(own | more))
        assert g.score == (1.0 if hits else best)
    assert licenses.scan(empty(spark)).count() == 0


# 8


def test_long_license_templates(spark):
    notice = " ".join(f"clause{i} of" for i in range(150))
    notices = [t for _, t in licenses.NOTICES]
    texts = [f"{'lead ' * lead}{notice.upper()} {'tail ' * 300}" for lead in (0, 31, 333)] + ["clause1 of clause2", None, "w " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, templates=(*licenses.TEMPLATES, ("own", notice))).collect()}
    assert got == {i: ("own", 1.0) if i < 3 else ("", 0.0) for i in range(6)}
    parts = spark.createDataFrame([(i, f"{'lead ' * 77}{t}{' tail' * 77}") for i, t in enumerate(notices)], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(parts).collect()} == {i: label for i, (label, _) in enumerate(licenses.NOTICES)}


def test_language_id(spark):
    rng = np.random.default_rng(8)
    stems = {"aa": ["kato", "milu", "taro", "sike"], "bb": ["schu", "grön", "pfer", "zwei"], "cc": ["que", "leur", "ç'eau", "rien"]}
    rows = []
    for i in range(400):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, " ".join("".join(rng.choice(stems[lang], rng.integers(1, 3))) for _ in range(rng.integers(4, 30))), lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 -- 34", None), (1003, "—", None), (1004, "漢字", None), (1005, "KATOKATOKATO", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == "und" for i in (1000, 1001, 1002, 1003)) and got[1004].lang_pred != "und" and got[1005].lang_pred == "aa"
    held = [(got[i], lang) for i, _, lang in rows[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held) and np.mean([r.lang_pred == lang for r, lang in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def brute_language(rows):
    """(lang_pred, score) of each row by the definition: words first, then the longest known n-grams."""
    word_of = lambda t: re.findall("[a-z\x80-\U0010ffff]+", (t or "").translate(LOW))
    grams = lambda w, n: [x[i : i + n] for x in (f"\x01{w}\x02",) for i in range(len(x) - n + 1)]
    train = [(t, x) for i, t, x in rows if x is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    langs = sorted({x for _, x in train})
    prior = [sum(x == y for _, y in train) / len(train) for x in langs]
    tables = {n: {} for n in range(6)}
    for t, x in train:
        for w in word_of(t):
            for n in range(6):
                for g in grams(w, n) if n else [w]:
                    tables[n].setdefault(g, [0.0] * len(langs))[langs.index(x)] += 1
    logs = {}
    for n, table in tables.items():
        kept = {g: np.array(c) + 0.5 for g, c in table.items() if sum(c) > 1}
        total = sum(kept.values()) if kept else 1
        logs[n] = {g: np.log(c / total) for g, c in kept.items()}
    out = []
    for _, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        z, ws = np.zeros(len(langs)), word_of(t)
        for w in ws:
            if w in logs[0]:
                z += logs[0][w]
                continue
            for n in (5, 4, 3, 2, 1):
                if known := [logs[n][g] for g in grams(w, n) if g in logs[n]]:
                    z += np.mean(known, 0)
                    break
        z = z / np.sqrt(max(len(ws), 1)) + np.log(prior)
        p = np.exp(z - z.max())
        out.append((langs[int(p.argmax())], p.max() / p.sum()))
    return out


def test_language_id_by_brute_force(spark):
    rng = np.random.default_rng(88)
    stems = {"aa": ["kato", "milu", "taro"], "bb": ["schu", "grön", "pfer"], "cc": ["que", "leur", "ç'eau", "kato"]}
    rows = []
    for i in range(90):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, " ".join("".join(rng.choice(stems[lang], rng.integers(1, 4))) for _ in range(rng.integers(1, 12))), lang if i % 5 else None))
    rows += [rows[7], rows[7], (200, None, "aa"), (201, "", None), (202, "12 !", "bb"), (203, "zzz 漢 qq", None), (204, "kato Schu " * 150_000, None), (205, "x" * 1_100_000, None), (206, "milu milugrön KATOX", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs).collect())
    want = sorted((i, *x) for (i, _, _), x in zip(rows, brute_language(rows), strict=True))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], atol=1e-3)


# 9


def brute_components(rows, k, num, den):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r.doc_id)
    return sorted((r.doc_id, len(sets[i]), min(groups[find(i)])) for i, r in enumerate(rows))


@pytest.mark.parametrize(("k", "num", "light", "pivots"), [(3, 90, 64, 8), (5, 80, 64, 8), (3, 80, 3, 1), (2, 50, 2, 1)])
def test_ngram_join(spark, monkeypatch, k, num, light, pivots):
    monkeypatch.setattr(ngram_join, "LIGHT", light)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    rng = np.random.default_rng(9)
    base = [f"v{i}" for i in range(60)]
    chain = []
    for _ in range(25):  # a chain and a star of near copies
        base = list(base)
        base[rng.integers(0, len(base))] = f"n{rng.integers(0, 10**6)}"
        chain.append(" ".join(base))
    docs = documents(spark, chain).withColumn("cls", F.lit("clash"))
    got = ngram_join.jaccard_components(docs, k, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(docs.collect(), k, num, 100)
    assert ngram_join.jaccard_components(empty(spark)).count() == 0


def test_ngram_join_groups(spark, monkeypatch):
    """Texts with most of their shingles in common that don't link: pairs grow in proportion to the group, and no link between two of them is lost."""
    settled, pairs = ngram_join.settled, {}

    def counted(df, name, small):
        out = settled(df, name, small)
        if name == "pairs":
            pairs[size] = pairs.get(size, 0) + out[1]
        return out

    monkeypatch.setattr(ngram_join, "settled", counted)
    for size in (100, 300):
        common_part, rows = [f"v{i}" for i in range(300)], []
        for i in range(size):
            tail = [f"t{i}_{j}" for j in range(45)]
            rows.append((3 * i, " ".join(common_part + tail)))
            if i % 10 == 0:  # these two link, and a third only with the second
                rows.append((3 * i + 1, " ".join(common_part[4:] + tail[:38])))
                rows.append((3 * i + 2, " ".join(common_part[30:] + tail[:38])))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = ngram_join.jaccard_components(docs, 5, 80, 100).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(docs.collect(), 5, 80, 100)
    assert pairs[300] <= 4 * pairs[100]


@pytest.mark.parametrize(("k", "num"), [(3, 80), (2, 50), (1, 90)])
def test_ngram_join_differences(spark, monkeypatch, k, num):
    """Near copies of a few texts and of each other, by scattered edits: differences from pivots lose no link."""
    monkeypatch.setattr(ngram_join, "LIGHT", 2)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    rng = np.random.default_rng(19)
    texts = [[f"w{i}_{j}" for j in range(50)] for i in range(2)]
    for _ in range(110):
        words = list(texts[rng.integers(0, len(texts))])
        for at in rng.integers(0, len(words), rng.integers(1, 8)):
            words[at] = f"e{rng.integers(0, 12)}" if rng.random() < 0.7 else ""
        texts.append(words)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    got = ngram_join.jaccard_components(docs, k, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(docs.collect(), k, num, 100)


def test_ngram_join_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, None), (8, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 7), (7, 7), (None, None), (8, 8)], key=str)


# 10


def test_loser_tree():
    rng = np.random.default_rng(10)
    for k in (0, 1, 2, 3, 7, 8):
        lists = [sorted(rng.integers(0, 50, rng.integers(0, 20)).tolist()) for _ in range(k)]
        assert [lists[i][j] for i, j in warc.LoserTree(lists)] == sorted(itertools.chain(*lists))


def test_warc(spark, monkeypatch):
    big, big2 = "<p>" + "ä" * 900, "x" * 1000
    rows = [(i, f"https://www.Example.com/a{i % 5}?q=ü {i % 2}", [big, big2, f"small {i % 3}", None, "y" * 999][i % 5]) for i in range(60)]
    rows += [(None, None, big), (None, "not a url\n", ""), (3, "https://e.org/", big), (57, "https://[bad", big2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = warc.archive(pages, range_captures=8).collect()
    assert len(got) == len(rows)
    keep = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= 1000:
            keep[b] = max(keep.get(b, -1), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and b in keep and keep[b] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keep[b] if again else None))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    order = sorted(got, key=lambda r: (r.part, r.pos))
    assert len({r.part for r in got}) > 1
    assert [(r.urlkey, r.timestamp) for r in order] == sorted((r.urlkey, r.timestamp) for r in got)
    assert [r.place_in_index for r in order] == list(range(len(rows)))
    monkeypatch.setattr(warc, "SENT", -1)  # the way without a broadcast, and runs of several files
    runs = warc.write_archives(pages.repartition(3), file_bytes=2000)
    assert runs.select("file").distinct().count() > 3
    again = sorted(((r.part, r.pos, r.urlkey, r.timestamp, r.page_id, r.kind) for r in warc.merge_runs(runs, 5).collect()), key=lambda x: x[:2])
    assert [x[2:4] for x in again] == [(r.urlkey, r.timestamp) for r in order]
    assert sorted(str(x[4:]) for x in again) == sorted(str((x[0], x[3])) for x in want)
    monkeypatch.setattr(warc, "MAX_RANGES", 2)
    assert {r.part for r in warc.merge_runs(runs, 1).collect()} == {0, 1}
    assert warc.archive(pages.limit(0)).count() == 0


def test_records_are_valid_warc():
    import gzip

    data = warc.record(5, "https://a.b/ü", b"<html>", hashlib.sha1(b"<html>").digest(), None)
    packed = gzip.compress(data)

    class Source:
        def __init__(self):
            self.left = packed * 3

        def read(self, n):
            out, self.left = self.left[:7], self.left[7:]
            return out

    found = list(warc._records(Source()))
    assert [p for p, *_ in found] == [0, len(packed), 2 * len(packed)]
    assert found[0][1]["WARC-Target-URI"] == "https://a.b/%C3%BC" and found[0][2].endswith(b"<html>")
    assert json.dumps(found[0][1])
