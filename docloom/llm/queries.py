"""One query per operator with production parameters, and the SQL of those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.llm import ann, chat, decontamination, grammar_output, language_id, licenses, mixing, ngram_join, quality, warc
from docloom.llm.common import table

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_NUMBER = "try_cast(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1) AS INT)"
#: The tree's first level: src0 to src4 are web, src5 to src14 books, the rest forums.  Read alike by Spark and DuckDB.
DOMAIN = f"CASE WHEN {_NUMBER} <= 4 THEN 'web' WHEN {_NUMBER} <= 14 THEN 'books' ELSE 'forum' END"


def mixture(budget_num: int = 8, budget_den: int = 10) -> mixing.Mixture:
    return mixing.Mixture(DOMAIN, {"web": 40, "books": 35, "forum": 25}, {"en": 50, "de": 20, "fr": 20, "es": 10}, {"src0": 3}, budget_num, budget_den, max_epochs=2, seed=17)


def op1_mixing(spark, sf_dir):
    return mixing.select(table(spark, sf_dir, "documents"), mixture())


def op2_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op3_grammar_output(spark, sf_dir):
    path = grammar_output.write_shards(table(spark, sf_dir, "documents"), end_id=2)
    return grammar_output.read_documents(spark, path)


def op4_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    escaped = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", escaped), (-7, 1, "assistant", escaped)], "conv_id long, turn long, role string, text string")
    return chat.read_chats(spark, chat.write_chats(turns.unionByName(extra)))


def op5_decontamination(spark, sf_dir):
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def proximity_matches(spark, sf_dir):
    """The index of op5 asked for words that stand near each other."""
    index = decontamination.build_index(table(spark, sf_dir, "documents"))
    return decontamination.proximity_hits(index, "license under", 4)


def op6_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op7_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "place_in_index")


def op9_ngram_jaccard(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


QUERIES = {
    f.__name__: f
    for f in (op1_mixing, op2_nearest, op3_grammar_output, op4_chat, op5_decontamination, proximity_matches, op6_quality, op7_licenses, op8_language_id, op9_ngram_jaccard, op10_warc)
}

_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _escaped(c: str) -> str:
    """The chat template's escape: backslashes are doubled, a control string gets one after its first sign."""
    out = f"replace({c}, '\\', '\\\\')"
    for x in chat.CONTROL:
        out = f"replace({out}, '{x}', '{x[0]}\\{x[1:]}')"
    return out


ORACLES = {
    "op1_mixing": mixing.sql(mixture()),
    "op7_licenses": licenses.sql(),
    "op4_chat": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_escaped("role")}) + length({_escaped("text")}) + {len("".join(chat.RESERVED))}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op10_warc": r"""
WITH u AS (SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www[0-9]*[.]', '') AS host, regexp_extract(lower(url), '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(lower(url), '^[^?#]*([?][^#]+)', 1) AS query FROM pages),
c AS (SELECT page_id, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || (CASE path WHEN '' THEN '/' ELSE path END) || query AS urlkey,
  strftime(TIMESTAMP '2020-01-01' + to_seconds(page_id), '%Y%m%d%H%M%S') AS timestamp FROM u),
o AS (SELECT *, row_number() OVER (ORDER BY urlkey, timestamp, page_id) - 1 AS place_in_index FROM c),
p AS (SELECT page_id, urlkey, timestamp, place_in_index, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages JOIN o USING (page_id)),
k AS (SELECT d, max(page_id) AS k FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, urlkey, timestamp, place_in_index, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest, CASE WHEN n >= 1000 AND page_id <> k THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> k THEN k END AS refers_to FROM p LEFT JOIN k USING (d)""",
    "op5_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, m, array_to_string(w[p : p + m - 1], ' ') AS k FROM (
  SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, m, p, array_to_string(w[p : p + m - 1], ' ') AS k FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, p, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.k = iw.k),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "proximity_matches": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d WHERE list_contains(w, 'license') AND list_contains(w, 'under'))
SELECT doc_id, CAST(p - 1 AS BIGINT) AS position FROM e WHERE w[p] = 'license' AND list_contains(w[greatest(p - 4, 1) : p + 4], 'under')""",
    "op9_ngram_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * o >= 90 * (na + nb - o)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT u.b, r.c FROM r JOIN u ON r.id = u.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.c AS component_id FROM s JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) c ON c.id = s.doc_id""",
}
