"""License scan: an exact set-similarity join of text blocks with license templates, in DataFrame operations alone.

A text's words are cut into blocks of BLOCK words, a new one every STRIDE, so
any passage of up to BLOCK - STRIDE words lies whole in a block.  Templates of
more than STRIDE words get blocks of their own: the stride is doubled until it
holds the template, the block is two strides.  A block meets a template when it holds at least THRESHOLD of the template's distinct
words (num / den, in whole numbers).

Template words are ordered globally by how many documents of the corpus hold
them, rarest first.  A text with fewer template words than the least template
needs is left at once (length filter).  A block can only meet a template if it holds one of the
template's first ``n - need + 1`` words (prefix filter), has at least ``need``
template words at all (length filter) and, at the common prefix word, both
sides have enough words left (positional filter).  Survivors are verified by
their exact overlap.  Templates are a fixed, small table and are broadcast.

Besides, phrases are searched word by word: the base labels.

Null and empty texts have no words and no labels, score 0.  Repeated rows are
reported one by one; rows of one id and one text share their blocks' result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import saved


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK, STRIDE = 64, 32
NUM, DEN = 85, 100

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Sentences of well-known licenses, and usual lines that name one.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_AS_IS = "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

#: Whole paragraphs of license notices.  sql() has TEMPLATES alone.
NOTICES = (
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY ' + _AS_IS),
    ("apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
)


def _words(text: str) -> list[str]:
    import re

    low = text.translate({i: i + 32 for i in range(65, 91)})
    return re.findall(WORD, low)


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.

    ``lower`` is far cheaper than a translation table.  It also lowers other
    letters, which no template and no phrase has; the two whose lower case
    holds an ASCII letter (U+212A, U+0130) are replaced first.
    """
    raw = F.coalesce(text.cast("string"), F.lit(""))
    low = F.lower(F.replace(F.replace(raw, F.lit("\u212a"), F.lit("\u0138")), F.lit("\u0130"), F.lit("\u0131")))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(_words(t)))) for label, t in templates]


def _stride(template: str) -> int:
    """The stride of the blocks in which a template lies whole."""
    stride, n = STRIDE, len(_words(template))
    while stride < n:
        stride *= 2
    return stride


def _need(words_of: list[str], num: int, den: int) -> int:
    return -(-len(words_of) * num // den)


def rank_words(rows: DataFrame, sets: list[tuple[str, list[str]]]) -> list[str]:
    """The templates' words in the global order: by the number of rows (held: a row's template words) that hold them, rarest first."""
    count = dict(rows.select(F.explode("held").alias("t")).groupBy("t").count().collect())  # one row a template word
    return sorted({w for _, s in sets for w in s}, key=lambda t: (count.get(t, 0), t))


def blocks_meeting(rows: DataFrame, sets: list[tuple[str, list[str]]], order: list[str], num: int = NUM, den: int = DEN, stride: int = STRIDE, length: int = BLOCK) -> DataFrame:
    """rows (key columns and w) joined with the templates their blocks meet: the keys, block, label, containment."""
    rank = {t: i for i, t in enumerate(order)}
    spark = rows.sparkSession
    entries, need_of = [], []
    for label, s in sets:
        ranks = sorted(rank[t] for t in s)
        need = _need(s, num, den)
        need_of.append(need)
        entries += [(r, label, ranks, len(ranks), need, i) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefix = spark.createDataFrame(entries, "rank int, label string, ranks array<int>, n int, need int, i int")
    keys = [c for c in rows.columns if c != "w"]
    hot = sorted({order[r] for r, *_ in entries})
    able = rows.where(F.arrays_overlap("w", _strings(hot)))
    cut = able.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(greatest(size(w), 1) - 1) div {stride}")))).where(f"block = 0 or size(w) > block * {stride} + {length - stride}")
    vocabulary = F.map_from_arrays(_strings(order), F.array(*[F.lit(i) for i in range(len(order))]))
    held = F.array_intersect(F.slice("w", F.col("block").cast("int") * stride + 1, length), _strings(order))
    cut = cut.select(*keys, "block", F.array_sort(F.transform(held, lambda t: vocabulary[t])).alias("b")).where(F.size("b") >= min(need_of))
    met = cut.select(*keys, "block", "b", F.posexplode("b").alias("j", "rank")).join(F.broadcast(prefix), "rank")
    met = met.where((F.size("b") >= F.col("need")) & (F.least(F.col("n") - F.col("i"), F.size("b") - F.col("j")) >= F.col("need")))
    # a block and a template with several common prefix words are verified at the first of them
    common = F.array_intersect("ranks", "b")
    met = met.where((F.array_min(common) == F.col("rank")) & (F.size(common) >= F.col("need")))
    return met.select(*keys, "block", "label", (F.size(common) / F.col("n")).alias("containment"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates=TEMPLATES + NOTICES) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best containment; 1 with a base label)."""
    sets = template_sets(templates)
    vocabulary = sorted({w for _, s in sets for w in s})
    none = F.expr("cast(array() as array<struct<p:int,label:string>>)")

    def places(phrase: str, label: str) -> Column:
        p = phrase.split()
        here = lambda i: F.forall(F.array(*[F.get("w", i + k) == t for k, t in enumerate(p)]), lambda x: F.coalesce(x, F.lit(False)))
        all_ = F.transform(F.filter(F.sequence(F.lit(0), F.size("w") - len(p)), here), lambda i: F.struct(i.alias("p"), F.lit(label).alias("label")))
        return F.when((F.size("w") >= len(p)) & F.array_contains("w", p[0]) & F.array_contains("w", p[-1]), all_).otherwise(none)

    hits = F.concat(*[places(p, label) for p, label in phrases.items()])
    # one scan: a text's words are cut once, and kept only where the whole text holds as many template words as some template needs
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("h"), words(F.col(text)).alias("w"))
    rows = rows.select("doc_id", "h", "w", F.array_intersect("w", _strings(vocabulary)).alias("held"))
    able = F.size("held") >= min((_need(s, NUM, DEN) for _, s in sets), default=1)
    rows = rows.select("doc_id", "h", F.size("w").cast("long").alias("n_words"), hits.alias("hits"), "held", F.when(able, F.col("w")).alias("w"))
    rows = saved(rows, "words")
    order = rank_words(rows, sets)
    found = None
    for stride in sorted({_stride(t) for _, t in templates}):
        own_sets = template_sets([x for x in templates if _stride(x[1]) == stride])
        own_words = {w for _, s in own_sets for w in s}
        met = blocks_meeting(rows.where("w is not null").select("doc_id", "h", "w"), own_sets, [w for w in order if w in own_words], stride=stride, length=max(BLOCK, 2 * stride))
        found = met if found is None else found.unionByName(met)
    found = found.groupBy("doc_id", "h").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")).withColumnsRenamed({"doc_id": "id", "h": "hh"})
    rows = rows.select(
        "doc_id", "h", "n_words", F.size("hits").cast("long").alias("n_base"), F.array_min("hits.p").cast("long").alias("first_word"), F.array_max("hits.p").cast("long").alias("last_word"), F.array_sort(F.array_distinct("hits.label")).alias("own"),
    )
    out = rows.join(found, rows.doc_id.eqNullSafe(found.id) & (rows.h == found.hh), "left")
    both = F.array_sort(F.array_union("own", F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def sql(phrases: dict[str, str] = PHRASES, templates=TEMPLATES) -> str:
    """DuckDB SQL for scan() over documents."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    hits = " UNION ALL ".join(f"SELECT doc_id, p - 1 AS p, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) - {len(p.split()) - 2})) AS p FROM d) WHERE w[p : p + {len(p.split()) - 1}] = {quoted(p.split())}" for p, label in phrases.items())
    sets = ", ".join(f"('{label}', {quoted(s)}, {-(-len(s) * NUM // DEN)})" for label, s in template_sets(templates))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({low}, '{WORD}') AS w FROM documents),
hit AS ({hits}),
h AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hit GROUP BY doc_id),
t AS (SELECT * FROM (VALUES {sets}) v(label, s, need)),
b AS (SELECT doc_id, list_distinct(w[k * {STRIDE} + 1 : k * {STRIDE} + {BLOCK}]) AS b FROM (SELECT doc_id, w, unnest(range(0, (greatest(len(w), 1) - 1) // {STRIDE} + 1)) AS k FROM d) WHERE k = 0 OR len(w) > k * {STRIDE} + {BLOCK - STRIDE}),
m AS (SELECT doc_id, label, len(list_intersect(b, s)) AS o, len(s) AS n, need FROM b, t),
f AS (SELECT doc_id, label, o / n AS c FROM m WHERE o >= need),
a AS (SELECT doc_id, label FROM f UNION SELECT doc_id, label FROM hit),
g AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM a GROUP BY doc_id),
s AS (SELECT doc_id, max(c) AS c FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN s USING (doc_id)"""
