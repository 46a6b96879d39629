"""Queries of the corpus-curation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.functions import extract
from kilnspark.operators import curate, near
from kilnspark.registry import query, table

QUALITY_SQL = """length(text) BETWEEN 100 AND 200000
  AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) >= 0.85
  AND len(regexp_extract_all(text, '[A-Za-z]{2,}')) >= 15"""

GRAMS_SQL = """
toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM {docs}),
grams AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i+12], ' '))) AS g FROM toks WHERE len(t) >= 13),
itoks AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM benchmark),
igrams AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i+12], ' '))) AS g FROM itoks WHERE len(t) >= 13),
hits AS (SELECT doc_id, item_id, count(*) AS shared FROM grams JOIN igrams USING (g) GROUP BY ALL)"""


@query("corpus_gram_counters", f"""
WITH q AS (SELECT *, coalesce({QUALITY_SQL}, false) AS ok FROM documents),
{GRAMS_SQL.format(docs="(SELECT * FROM q WHERE ok)")},
leaks AS (SELECT doc_id FROM hits GROUP BY doc_id HAVING max(shared) >= 50),
clean AS (SELECT * FROM q WHERE ok AND doc_id NOT IN (SELECT doc_id FROM leaks)),
firsts AS (SELECT min(doc_id) AS doc_id FROM clean GROUP BY sha1(text)),
r AS (SELECT source, CASE WHEN NOT ok THEN 'quality' WHEN doc_id IN (SELECT doc_id FROM leaks) THEN 'leak'
  WHEN doc_id IN (SELECT doc_id FROM firsts) THEN 'kept' ELSE 'duplicate' END AS reason FROM q)
SELECT source, reason, count(*) AS n FROM r GROUP BY ALL""")
def corpus_gram_counters(spark, sf_dir):
    reasons = curate.drop_reasons(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return reasons.groupBy("source", "reason").agg(F.count("*").alias("n"))


#: Distinct shingles of 13 tokens of ``{rows}`` (id, text).
SHINGLES_SQL = """
{name}_toks AS (SELECT id, regexp_extract_all(lower(text), '[a-z0-9_.-]+') AS t FROM {rows}),
{name} AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i+12], ' '))) AS g FROM {name}_toks WHERE len(t) >= 13),
{name}_size AS (SELECT id, count(*) AS n FROM {name} GROUP BY 1)"""

_NEAR_ITEMS_SQL = """
leak_near AS (SELECT DISTINCT s.id FROM (SELECT d.id, b.id AS item, count(*) AS c FROM dg d JOIN bg b USING (g) GROUP BY ALL) s JOIN dg_size x ON x.id = s.id JOIN bg_size y ON y.id = s.item WHERE 1000 * c >= 300 * (x.n + y.n - c))"""

#: Near pairs, and the first ones that win, text by text in the order of ids.
_FIRST_WINS_SQL = """
pairs AS (SELECT s.id, s.before FROM (SELECT a.id, b.id AS before, count(*) AS c FROM cg a JOIN cg b ON a.g = b.g AND b.id < a.id GROUP BY ALL) s JOIN dg_size x ON x.id = s.id JOIN dg_size y ON y.id = s.before WHERE 1000 * c >= 800 * (x.n + y.n - c)),
late AS (SELECT id, row_number() OVER (ORDER BY id) AS place FROM (SELECT DISTINCT id FROM pairs)),
fold AS (
  SELECT 0::BIGINT AS place, []::BIGINT[] AS gone
  UNION ALL
  SELECT f.place + 1, CASE WHEN EXISTS (SELECT 1 FROM pairs p WHERE p.id = l.id AND NOT list_contains(f.gone, p.before)) THEN list_append(f.gone, l.id) ELSE f.gone END
  FROM fold f JOIN late l ON l.place = f.place + 1
),
near_dup AS (SELECT unnest(gone) AS id FROM fold WHERE place = (SELECT max(place) FROM fold))"""


@query("near_benchmark_items", f"""
WITH {SHINGLES_SQL.format(name="dg", rows="(SELECT doc_id AS id, text FROM documents)")}, {SHINGLES_SQL.format(name="bg", rows="(SELECT item_id AS id, text FROM benchmark)")}, {_NEAR_ITEMS_SQL}
SELECT id FROM leak_near""")
def near_benchmark_items(spark, sf_dir):
    """Documents near a benchmark item: MinHash of 128 permutations, bands of one row, Jaccard of 0.3 on 13-token shingles."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return near.near_items(near.shingle_sets(docs, "doc_id"), near.shingle_sets(items, "item_id"))


@query("near_first_wins", f"""
WITH RECURSIVE {SHINGLES_SQL.format(name="dg", rows="(SELECT doc_id AS id, text FROM documents)")}, cg AS (SELECT * FROM dg), {_FIRST_WINS_SQL}
SELECT id FROM near_dup""")
def near_first_wins(spark, sf_dir):
    """Documents near an earlier one that is kept: Jaccard of 0.8 on 13-token shingles, in the order of ids."""
    return near.first_wins(near.materialise(near.shingle_sets(table(spark, sf_dir, "documents"), "doc_id")))


@query("minhash_signatures")
def minhash_signatures(spark, sf_dir):
    """128 least values of each document with a shingle of 13 tokens."""
    return near.shingle_sets(table(spark, sf_dir, "documents"), "doc_id").select(F.col("id").alias("doc_id"), near.signature("sh").alias("signature"))


_STRICT = ("src1", "src7")
_LONG_IDS_SQL = r"list_distinct(list_transform(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Za-z]{12,}')), lambda x: upper(x)))"


@query("corpus_drop_counters", f"""
WITH RECURSIVE q AS (SELECT *, coalesce({QUALITY_SQL}, false) AS ok FROM documents),
leak_exact AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest({_LONG_IDS_SQL}) AS x FROM q WHERE ok AND source IN {_STRICT}) WHERE x IN (SELECT unnest({_LONG_IDS_SQL}) FROM benchmark)),
clean AS (SELECT doc_id, source, sha1(text) AS h, text FROM q WHERE ok AND doc_id NOT IN (SELECT doc_id FROM leak_exact)),
firsts AS (SELECT h, min(doc_id) AS id FROM clean GROUP BY 1),
{SHINGLES_SQL.format(name="dg", rows="(SELECT f.id, c.text FROM firsts f JOIN clean c ON c.doc_id = f.id)")},
{SHINGLES_SQL.format(name="bg", rows="(SELECT item_id AS id, text FROM benchmark)")}, {_NEAR_ITEMS_SQL},
cg AS (SELECT * FROM dg WHERE id NOT IN (SELECT id FROM leak_near)), {_FIRST_WINS_SQL},
told AS (SELECT c.doc_id, c.source, CASE WHEN f.id IN (SELECT id FROM leak_near) THEN 'leak_near' WHEN f.id <> c.doc_id OR f.id IN (SELECT id FROM near_dup) THEN 'near_dup' ELSE 'kept' END AS reason FROM clean c JOIN firsts f USING (h)),
r AS (SELECT source, reason FROM told UNION ALL SELECT source, CASE WHEN ok THEN 'leak_exact' ELSE 'quality' END FROM q WHERE doc_id NOT IN (SELECT doc_id FROM told))
SELECT source, CASE WHEN grouping(reason) = 1 THEN 'total' ELSE reason END AS reason, count(*) AS n FROM r GROUP BY GROUPING SETS ((source), (source, reason))""")
def corpus_drop_counters(spark, sf_dir):
    """Counters of the corpus build by source: total, quality, leak_exact, leak_near, near_dup, kept."""
    ids = lambda c: F.filter(extract.ids(c, r"[\p{L}\p{N}_]+"), lambda x: x.rlike("^[A-Z]{12,}$"))
    reasons = near.corpus_reasons(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ids, F.col("source").isin(*_STRICT))
    counted = reasons.groupBy("source", "reason").agg(F.count("*").alias("n"))
    return counted.unionByName(counted.groupBy("source").agg(F.sum("n").alias("n")).withColumn("reason", F.lit("total")))
