"""Queries of the evaluation operators: predictions are derived from the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from kilnspark.functions import extract as E
from kilnspark.operators import metrics as M
from kilnspark.registry import query, table

# a prediction that is right for most rows: the label, flipped where doc_id % 4 = 0
_PRED = "SELECT doc_id, quality, toxic, CASE WHEN doc_id % 4 = 0 THEN 1 - quality ELSE quality END AS pred FROM labels"


def _pred(spark, sf):
    d = table(spark, sf, "labels")
    return d.withColumn("pred", F.when(F.col("doc_id") % 4 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))


@query("metric_accuracy_mcc", f"""WITH p AS ({_PRED}), c AS (SELECT sum((pred=1 AND quality=1)::INT)::DOUBLE tp, sum((pred=1 AND quality<>1)::INT)::DOUBLE fp, sum((pred<>1 AND quality=1)::INT)::DOUBLE fn, sum((pred<>1 AND quality<>1)::INT)::DOUBLE tn FROM p)
SELECT (tp+tn)/(tp+fp+fn+tn) AS accuracy, 2*tp/(2*tp+fp+fn) AS f1, CASE WHEN (tp+fp)*(tp+fn)*(tn+fp)*(tn+fn) > 0 THEN (tp*tn-fp*fn)/sqrt((tp+fp)*(tp+fn)*(tn+fp)*(tn+fn)) ELSE 0 END AS mcc FROM c""")
def metric_accuracy_mcc(spark, sf):
    return M.matthews(_pred(spark, sf), "pred", "quality")


_LANGS = ("en", "fr", "de", "es")


@query("metric_macro_f1", "WITH p AS (SELECT lang AS gold, CASE WHEN doc_id % 5 = 0 THEN 'en' ELSE lang END AS pred FROM documents), l AS (SELECT unnest(['en', 'fr', 'de', 'es']) AS x), f AS (SELECT x, sum((pred = x AND gold = x)::INT) AS tp, sum((pred = x)::INT) AS p, sum((gold = x)::INT) AS g FROM p, l GROUP BY x) SELECT (SELECT avg((pred = gold)::INT) FROM p) AS accuracy, avg(CASE WHEN p + g > 0 THEN 2.0 * tp / (p + g) ELSE 0 END) AS macro_f1 FROM f")
def metric_macro_f1(spark, sf):
    d = table(spark, sf, "documents")
    return M.macro_f1(d.select(F.col("lang").alias("gold"), F.when(F.col("doc_id") % 5 == 0, "en").otherwise(F.col("lang")).alias("pred")), "pred", "gold", list(_LANGS))


@query("metric_category_accuracy", f"WITH p AS ({_PRED}) SELECT source, avg((pred = quality)::INT) AS accuracy, count(*) AS n FROM p JOIN documents USING (doc_id) GROUP BY source")
def metric_category_accuracy(spark, sf):
    j = _pred(spark, sf).join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return j.groupBy("source").agg(F.avg((F.col("pred") == F.col("quality")).cast("int")).alias("accuracy"), F.count("*").alias("n"))


@query("metric_slices", """WITH r AS (SELECT lang, source, doc_id % 9 = 0 AS failed, (doc_id % 3)::DOUBLE / 2 AS score FROM documents)
SELECT lang, source, sum((NOT failed)::INT) AS answered, sum(failed::INT) AS parse_errors, avg(CASE WHEN NOT failed THEN score END) AS avg_score, 100.0 * sum((NOT failed AND score = 1)::INT) / sum((NOT failed)::INT) AS strict_pct FROM r GROUP BY GROUPING SETS ((), (lang), (source))""")
def metric_slices(spark, sf):
    """Buckets over all rows, by language and by source in one pass."""
    r = table(spark, sf, "documents").select("lang", "source", (F.col("doc_id") % 9 == 0).alias("failed"), ((F.col("doc_id") % 3) / 2).alias("score"))
    g = r.groupingSets([[], ["lang"], ["source"]], "lang", "source")
    ok = ~F.col("failed")
    return g.agg(F.count_if(ok).alias("answered"), F.count_if("failed").alias("parse_errors"), F.avg(F.when(ok, F.col("score"))).alias("avg_score"), (100.0 * F.count_if(ok & (F.col("score") == 1)) / F.count_if(ok)).alias("strict_pct"))


@query("metric_mean_success", "SELECT source, avg(n_chars) FILTER (WHERE doc_id % 6 <> 0) AS mean_score, count(*) FILTER (WHERE doc_id % 6 <> 0) AS n FROM documents GROUP BY source")
def metric_mean_success(spark, sf):
    ok = F.col("doc_id") % 6 != 0
    return table(spark, sf, "documents").groupBy("source").agg(F.avg(F.when(ok, F.col("n_chars"))).alias("mean_score"), F.count_if(ok).alias("n"))


@query("metric_severity_mad", "SELECT avg(abs(a - b)) AS mad, 1 - avg(abs(a - b)) / 7.7 AS accuracy FROM (SELECT CASE WHEN doc_id % 13 <> 0 THEN (doc_id % 78) / 7.8 END AS a, (doc_id % 50) / 5.0 AS b FROM documents)")
def metric_severity_mad(spark, sf):
    """Rows whose score can't be read have none and don't count."""
    d = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 13 != 0, (F.col("doc_id") % 78) / 7.8).alias("a"), ((F.col("doc_id") % 50) / 5.0).alias("b"))
    mad = F.avg(F.abs(F.col("a") - F.col("b")))
    return d.agg(mad.alias("mad"), (1 - mad / 7.7).alias("accuracy"))


@query("metric_choice_legacy", "WITH r AS (SELECT substring('ABCDXQ', 1 + doc_id % 6, 1) AS pred, substring('ABCDXQ', 1 + (doc_id * 7) % 6, 1) AS gold FROM documents) SELECT sum((pred = gold)::INT)::DOUBLE / sum((pred IN ('A','B','C','D','X'))::INT) AS accuracy FROM r")
def metric_choice_legacy(spark, sf):
    """The denominator holds only valid predictions, the numerator any equality."""
    i = F.col("doc_id")
    pick = lambda k: F.substring(F.lit("ABCDXQ"), (k % 6 + 1).cast("int"), F.lit(1))
    r = table(spark, sf, "documents").select(pick(i).alias("pred"), pick(i * 7).alias("gold"))
    return r.agg((F.count_if(F.col("pred") == F.col("gold")).cast("double") / F.count_if(F.col("pred").isin(*"ABCDX"))).alias("accuracy"))


_SETS = "SELECT doc_id, list_distinct([doc_id % 5, doc_id % 3, doc_id % 7]) AS p, CASE WHEN doc_id % 10 = 0 THEN [] ELSE list_distinct([doc_id % 4, doc_id % 6]) END AS g FROM documents"


def _sets(spark, sf):
    i = F.col("doc_id")
    empty = F.array().cast("array<bigint>")
    return table(spark, sf, "documents").select("doc_id", F.array_distinct(F.array(i % 5, i % 3, i % 7)).alias("p"), F.when(i % 10 == 0, empty).otherwise(F.array_distinct(F.array(i % 4, i % 6))).alias("g"))


@query("metric_set_scores", f"WITH s AS ({_SETS}), k AS (SELECT *, len(list_intersect(p, g)) AS h FROM s) SELECT doc_id, CASE WHEN len(g) = 0 THEN NULL WHEN h > 0 THEN 2.0 * h / (len(p) + len(g)) ELSE 0 END AS f1, h / (len(p) + len(g) - h)::DOUBLE AS jaccard FROM k")
def metric_set_scores(spark, sf):
    return _sets(spark, sf).select("doc_id", M.f1(F.col("p"), F.col("g")).alias("f1"), M.jaccard(F.col("p"), F.col("g")).alias("jaccard"))


@query("metric_set_macro", f"WITH s AS ({_SETS}), k AS (SELECT *, len(list_intersect(p, g)) AS h FROM s) SELECT avg(CASE WHEN h > 0 THEN 2.0 * h / (len(p) + len(g)) ELSE 0 END) AS macro_f1, count(*) AS n FROM k WHERE len(g) > 0")
def metric_set_macro(spark, sf):
    s = _sets(spark, sf).select(M.f1(F.col("p"), F.col("g")).alias("f1")).where("f1 is not null")
    return s.agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("n"))


@query("metric_tiered", f"""WITH s AS ({_SETS}), k AS (SELECT doc_id, p, g, list_filter([1::BIGINT, 2::BIGINT], lambda x: NOT list_contains(g, x)) AS q FROM s),
h AS (SELECT doc_id, len(list_intersect(p, g)) AS good, len(list_intersect(p, q)) AS near, len(p) AS np, len(g) AS ng FROM k), pr AS (SELECT *, (good + near)::DOUBLE / greatest(np, 1) AS pre, good::DOUBLE / greatest(ng, 1) AS rec FROM h)
SELECT doc_id, CASE WHEN good = 0 AND near > 0 THEN 0.5 WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0 END AS score FROM pr""")
def metric_tiered(spark, sf):
    plausible = F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))
    return _sets(spark, sf).select("doc_id", M.tiered_f1(F.col("p"), F.col("g"), plausible).alias("score"))


@query("metric_overall", "SELECT avg(a) AS overall FROM (SELECT lang, avg(n_chars) AS a FROM documents GROUP BY lang)")
def metric_overall(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.avg("n_chars").alias("a")).agg(F.avg("a").alias("overall"))


@query("cost_rollup", """SELECT c_mktsegment AS family, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS DOUBLE) AS urgent, CAST(sum(o_totalprice) AS DOUBLE) AS total, 1000.0 * CAST(sum(o_totalprice) AS DOUBLE) / count(*) AS per_thousand
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment ORDER BY total DESC""")
def cost_rollup(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    g = j.groupBy(F.col("c_mktsegment").alias("family")).agg(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0)).cast("double").alias("urgent"), F.sum("o_totalprice").cast("double").alias("total"), F.count("*").alias("n"))
    return g.select("family", "urgent", "total", (1000.0 * F.col("total") / F.col("n")).alias("per_thousand")).orderBy(F.desc("total"))


@query("cost_tiers", "SELECT doc_id, CASE WHEN n_chars BETWEEN 0 AND 1000 THEN n_chars * 1.25 / 1e6 WHEN n_chars BETWEEN 1001 AND 8000 THEN n_chars * 2.5 / 1e6 WHEN n_chars >= 10000 THEN n_chars * 5.0 / 1e6 ELSE 0 END AS cost FROM documents")
def cost_tiers(spark, sf):
    return table(spark, sf, "documents").select("doc_id", M.tier_cost(F.col("n_chars"), [(0, 1000, 1.25), (1001, 8000, 2.5), (10000, None, 5.0)]).alias("cost"))


@query("cost_keep_max", "WITH r AS (SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN '' ELSE source END AS model_key, n_chars AS cost FROM documents) SELECT doc_id, model_key FROM (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY cost DESC, doc_id) AS rn FROM r WHERE model_key <> '') WHERE rn = 1 UNION ALL SELECT doc_id, model_key FROM r WHERE model_key = ''")
def cost_keep_max(spark, sf):
    r = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 8 == 0, "").otherwise(F.col("source")).alias("model_key"), F.col("n_chars").alias("cost"))
    best = r.where("model_key <> ''").groupBy("model_key").agg(F.max_by("doc_id", F.struct("cost", -F.col("doc_id"))).alias("doc_id"))
    return best.select("doc_id", "model_key").union(r.where("model_key = ''").select("doc_id", "model_key"))


@query("latest_summary", "SELECT user_id, event_type, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY user_id, event_type")
def latest_summary(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("best_response_file", "SELECT source, lang FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS rn FROM documents GROUP BY source, lang) WHERE rn = 1")
def best_response_file(spark, sf):
    c = table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    w = Window.partitionBy("source").orderBy(F.desc("n"), "lang")
    return c.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("source", "lang")


@query("dedupe_keep_latest", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, source DESC, doc_id DESC) AS rn FROM documents) WHERE rn = 1")
def dedupe_keep_latest(spark, sf):
    """Latest by published, modified, load order: one aggregate instead of a sort of each group."""
    return table(spark, sf, "documents").groupBy("text").agg(F.max_by("doc_id", F.struct("n_chars", "source", "doc_id")).alias("doc_id")).select("doc_id")


@query("prefer_primary", "SELECT o_orderkey, arg_min(l_linenumber, struct_pack(a := (l_returnflag <> 'R')::INT, b := l_linenumber)) AS line FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def prefer_primary(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min_by("l_linenumber", F.struct((F.col("l_returnflag") != "R").cast("int"), "l_linenumber")).alias("line"))


@query("length_stats", r"SELECT lang, CASE WHEN w < 100 THEN '000-099' WHEN w < 500 THEN '100-499' ELSE '500+' END AS bin, count(*) AS n, avg(w) AS mean, stddev_samp(w) AS sd FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS w FROM documents) GROUP BY ALL")
def length_stats(spark, sf):
    w = table(spark, sf, "documents").select("lang", F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("w"))
    b = F.when(F.col("w") < 100, "000-099").when(F.col("w") < 500, "100-499").otherwise("500+")
    return w.groupBy("lang", b.alias("bin")).agg(F.count("*").alias("n"), F.avg("w").alias("mean"), F.stddev_samp("w").alias("sd"))


@query("length_cdf", "WITH b AS (SELECT n_chars // 1000 * 1000 AS bin, count(*) AS n FROM documents GROUP BY 1) SELECT bin, n, sum(n) OVER (ORDER BY bin)::BIGINT AS upto, 100.0 * sum(n) OVER (ORDER BY bin) / sum(n) OVER () AS pct FROM b")
def length_cdf(spark, sf):
    """The window runs over the bins, which are few, not over the rows."""
    b = table(spark, sf, "documents").groupBy((F.floor(F.col("n_chars") / 1000) * 1000).alias("bin")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("bin"))
    return b.select("bin", "n", upto.alias("upto"), (100.0 * upto / F.sum("n").over(Window.partitionBy())).alias("pct"))


@query("duplicate_hashes", "SELECT sha256(text) AS h, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_hashes(spark, sf):
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("diagnosis", "SELECT CASE WHEN doc_id % 4 <> 0 THEN 'correct' WHEN toxic = 1 THEN 'extraction_miss' WHEN quality = 0 THEN 'parser_false_zero' ELSE 'wrong_answer' END AS bucket, count(*) AS n FROM labels GROUP BY 1")
def diagnosis(spark, sf):
    b = F.when(F.col("pred") == F.col("quality"), "correct").when(F.col("toxic") == 1, "extraction_miss").when(F.col("quality") == 0, "parser_false_zero").otherwise("wrong_answer")
    return _pred(spark, sf).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))


@query("valid_token_ratio", "SELECT avg(r) AS ratio FROM (SELECT (doc_id % 10) / 10.0 AS r FROM documents)")
def valid_token_ratio(spark, sf):
    i = (F.col("doc_id") % 10).cast("int")
    labels = F.concat(F.array_repeat(F.lit(-100), 10 - i), F.array_repeat(F.lit(7), i))
    return table(spark, sf, "documents").select(labels.alias("l")).agg(F.avg(F.size(F.filter("l", lambda x: x != -100)) / F.size("l")).alias("ratio"))


@query("exact_match_accuracy", "SELECT avg((upper(lang) = upper(CASE WHEN doc_id % 3 = 0 THEN 'En' ELSE lang END))::INT) AS accuracy FROM documents")
def exact_match_accuracy(spark, sf):
    p = F.when(F.col("doc_id") % 3 == 0, "En").otherwise(F.col("lang"))
    return table(spark, sf, "documents").agg(F.avg((F.upper("lang") == F.upper(p)).cast("int")).alias("accuracy"))


@query("pearson", "SELECT round(corr(n_chars, length(text) + doc_id % 17), 9) AS r FROM documents")
def pearson(spark, sf):
    return table(spark, sf, "documents").agg(F.round(F.corr("n_chars", F.length("text") + F.col("doc_id") % 17), 9).alias("r"))


@query("elapsed_format", "SELECT doc_id, CASE WHEN n_chars >= 3600 THEN format('{:d}h{:02d}m{:02d}s', n_chars // 3600, n_chars % 3600 // 60, n_chars % 60) WHEN n_chars >= 60 THEN format('{:d}m{:02d}s', n_chars // 60, n_chars % 60) ELSE format('{:d}s', n_chars) END AS t FROM documents")
def elapsed_format(spark, sf):
    return table(spark, sf, "documents").select("doc_id", M.elapsed(F.col("n_chars")).alias("t"))


@query("infer_lengths", "WITH r AS (SELECT doc_id, doc_id % 977 + 1 AS s, doc_id % 613 + 1 AS t FROM documents), k AS (SELECT *, least(CASE WHEN t * 2 < 500 THEN 500 WHEN s * 2 < 500 THEN 500 - s ELSE floor(500 * t / (s + t)::DOUBLE) END, t) AS nt FROM r) SELECT doc_id, least(greatest(500 - nt, 0), s)::BIGINT AS source_len, nt::BIGINT AS target_len FROM k")
def infer_lengths(spark, sf):
    r = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 977 + 1).alias("s"), (F.col("doc_id") % 613 + 1).alias("t"))
    s, t = M.infer_lengths(F.col("s"), F.col("t"), 500)
    return r.select("doc_id", s.cast("long").alias("source_len"), t.cast("long").alias("target_len"))


@query("cvss_scores", """WITH v AS (SELECT doc_id, substring('NALP', 1 + doc_id % 4, 1) av, substring('LH', 1 + doc_id % 2, 1) ac, substring('NLH', 1 + doc_id % 3, 1) pr, substring('NR', 1 + (doc_id // 2) % 2, 1) ui, substring('UC', 1 + (doc_id // 3) % 2, 1) s, substring('HLN', 1 + (doc_id // 5) % 3, 1) c, substring('HLN', 1 + (doc_id // 7) % 3, 1) i, substring('HLN', 1 + (doc_id // 11) % 3, 1) a FROM documents),
w AS (SELECT doc_id, s, CASE av WHEN 'N' THEN 0.85::DOUBLE WHEN 'A' THEN 0.62 WHEN 'L' THEN 0.55 ELSE 0.2 END av, CASE ac WHEN 'L' THEN 0.77::DOUBLE ELSE 0.44 END ac, CASE WHEN pr = 'N' THEN 0.85::DOUBLE WHEN pr = 'L' THEN CASE WHEN s = 'C' THEN 0.68 ELSE 0.62 END ELSE CASE WHEN s = 'C' THEN 0.5 ELSE 0.27 END END pr, CASE ui WHEN 'N' THEN 0.85::DOUBLE ELSE 0.62 END ui,
 CASE c WHEN 'H' THEN 0.56::DOUBLE WHEN 'L' THEN 0.22 ELSE 0 END c, CASE i WHEN 'H' THEN 0.56::DOUBLE WHEN 'L' THEN 0.22 ELSE 0 END i, CASE a WHEN 'H' THEN 0.56::DOUBLE WHEN 'L' THEN 0.22 ELSE 0 END a FROM v),
x AS (SELECT doc_id, s, 1 - (1 - c) * (1 - i) * (1 - a) AS iss, 8.22::DOUBLE * av * ac * pr * ui AS ease FROM w), y AS (SELECT doc_id, s, ease, CASE WHEN s = 'C' THEN 7.52::DOUBLE * (iss - 0.029) - 3.25 * pow(iss - 0.02, 15) ELSE 6.42::DOUBLE * iss END AS impact FROM x),
z AS (SELECT doc_id, impact, CAST(round(least(10::DOUBLE, CASE WHEN s = 'C' THEN 1.08::DOUBLE * (impact + ease) ELSE impact + ease END) * 100000) AS BIGINT) AS k FROM y)
SELECT doc_id, CASE WHEN impact <= 0 THEN 0 WHEN k % 10000 = 0 THEN k / 100000.0 ELSE (k // 10000 + 1) / 10.0 END AS score FROM z""")
def cvss_scores(spark, sf):
    i = F.col("doc_id")
    pick = lambda s, k: F.substring(F.lit(s), (k % len(s) + 1).cast("int"), F.lit(1))
    fl = lambda n: F.floor(i / n)
    parts = [("AV", "NALP", i), ("AC", "LH", i), ("PR", "NLH", i), ("UI", "NR", fl(2)), ("S", "UC", fl(3)), ("C", "HLN", fl(5)), ("I", "HLN", fl(7)), ("A", "HLN", fl(11))]
    vector = F.concat(F.lit("CVSS:3.1"), *[x for n, s, k in parts for x in (F.lit(f"/{n}:"), pick(s, k))])
    return table(spark, sf, "documents").select("doc_id", vector.alias("v")).select("doc_id", M.cvss31(F.col("v")).alias("score"))


# ------------------------------------------------------------ extraction

_TEXT = "'Thought.\\nAnswer: ' || substring('ABCD', 1 + doc_id % 4, 1) || '\\nThe id is cve-2024-' || (1000 + doc_id) || ' and CVE-CVE-2023-' || (2000 + doc_id) || '.\\nTherefore, ' || substring('EFGH', 1 + doc_id % 4, 1) || '.'"


def _answers(spark, sf):
    i = F.col("doc_id")
    pick = lambda s: F.substring(F.lit(s), (i % 4 + 1).cast("int"), F.lit(1))
    x = F.concat(F.lit("Thought.\nAnswer: "), pick("ABCD"), F.lit("\nThe id is cve-2024-"), 1000 + i, F.lit(" and CVE-CVE-2023-"), 2000 + i, F.lit(".\nTherefore, "), pick("EFGH"), F.lit("."))
    return table(spark, sf, "documents").select("doc_id", x.alias("x"))


@query("extract_answers", rf"""WITH r AS (SELECT doc_id, replace({_TEXT}, '\n', chr(10)) AS x FROM documents)
SELECT doc_id, regexp_extract(x, '(?i)answer:\s*([A-J])', 1) AS choice, 'CVE-2023-' || (2000 + doc_id) AS last_id, ['CVE-2024-' || (1000 + doc_id), 'CVE-2023-' || (2000 + doc_id)] AS ids, replace(x, 'CVE-CVE-', 'CVE-') AS clean FROM r""")
def extract_answers(spark, sf):
    x = F.col("x")
    return _answers(spark, sf).select("doc_id", E.choice(x).alias("choice"), E.bottom_up(x, r"CVE-\d{4}-\d+").alias("last_id"), E.ids(x, r"(?i)CVE-\d{4}-\d+").alias("ids"), E.collapse_prefixes(x).alias("clean"))


@query("extract_sections", "SELECT doc_id, 'Do it.' AS instruction, lang AS input, source AS output FROM documents")
def extract_sections(spark, sf):
    x = F.concat(F.lit("Instruction: Do it.\n  Question: "), "lang", F.lit("\nAnswer: "), "source")
    return table(spark, sf, "documents").select("doc_id", E.instruction_parts(x).alias("s")).select("doc_id", "s.*")


@query("text_repairs", r"SELECT doc_id, '{a}[' || lang || ']' AS unescaped, 'body ' || doc_id AS cut, 'visible' AS spoken, ['A', 'C'] AS letters FROM documents")
def text_repairs(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", E.unescape(F.concat(F.lit("<OBR>a<CBR><OBK>"), "lang", F.lit("<CBK>"))).alias("unescaped"),
        E.cut_at(F.concat(F.lit("body "), "doc_id", F.lit("  \n## Notes: x")), ["\n## Notes", "## Extra"]).alias("cut"),
        E.strip_thought(F.lit("<think>hidden\nlines</think>\n visible")).alias("spoken"), E.letters(F.lit('{"answers": ["C", "A", "C"]}')).alias("letters"),
    )


@query("first_sentences", r"SELECT doc_id, substring(string_split(regexp_replace(trim(regexp_replace(text, '\n+', ' ', 'g'), ' '), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))[1], 1, 400) AS head FROM documents")
def first_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", E.first_sentence(F.col("text")).alias("head"))


@query("url_functions", r"SELECT page_id, substring(sha1(url), 1, 16) AS url_id, lower(regexp_extract(url, '^([A-Za-z]+://[^/?]*)', 1)) || regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z]+://[^/?]*', ''), '/+$', '') AS canonical FROM pages")
def url_functions(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.substring(F.sha1("url"), 1, 16).alias("url_id"), E.canonical_url(F.col("url")).alias("canonical"))


def uuid5_sql(name: str) -> str:
    """Version-5 UUID of a text column under example.org, in SQL."""
    space = uuid.uuid5(uuid.NAMESPACE_DNS, "example.org").hex
    h = f"sha1(unhex('{space}') || encode({name}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', CAST(CAST('0x' || substr({h}, 17, 1) AS INT) % 4 + 1 AS INT), 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


@query("uuid5_ids", f"SELECT c_custkey, {uuid5_sql('c_name')} AS stix_id FROM customer")
def uuid5_ids(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", E.uuid5(uuid.uuid5(uuid.NAMESPACE_DNS, "example.org").bytes, F.col("c_name")).alias("stix_id"))


@query("page_text", r"""WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<nav\b.*?</nav\s*>|<header\b.*?</header\s*>|<footer\b.*?</footer\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS h FROM pages),
b AS (SELECT page_id, url, replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS t FROM a)
SELECT page_id, url, trim(regexp_replace(t, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS text FROM b WHERE length(trim(regexp_replace(t, '[ \t\n\x0B\f\r]+', ' ', 'g'))) >= 400""")
def page_text(spark, sf):
    """Visible text of pages, short pages dropped."""
    t = table(spark, sf, "pages").select("page_id", "url", E.html_text(F.col("html")).alias("text"))
    return t.where(F.length("text") >= 400)


@query("rank_correlations", """WITH v AS (SELECT (n_chars // 100)::DOUBLE AS p, (length(text) // 250 + doc_id % 7)::DOUBLE AS g FROM documents),
r AS (SELECT p, g, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rp, rank() OVER (ORDER BY g) + (count(*) OVER (PARTITION BY g) - 1) / 2.0 AS rg FROM v)
SELECT round(corr(rp, rg), 9) AS spearman, round(corr(p, g), 9) AS pearson FROM r""")
def rank_correlations(spark, sf):
    """Ties share their mean rank."""
    d = table(spark, sf, "documents").select(F.floor(F.col("n_chars") / 100).alias("p"), (F.floor(F.length("text") / 250) + F.col("doc_id") % 7).alias("g"))
    return M.spearman(d, "p", "g").select(*[F.round(c, 9).alias(c) for c in ("spearman", "pearson")])


@query("question_scores", f"""WITH p AS ({_PRED}), e AS (SELECT doc_id // 5 AS q, sum((pred = 1 AND quality = 1)::INT) AS tp, sum((pred = 1)::INT) AS p, sum((quality = 1)::INT) AS g, min((pred = quality)::INT) AS ok FROM p GROUP BY 1)
SELECT round(avg(ok), 9) AS exact_match, round(avg(CASE WHEN p + g > 0 THEN 2.0 * tp / (p + g) ELSE 0 END), 9) AS f1_m, round(2.0 * sum(tp) / (sum(p) + sum(g)), 9) AS f1_a FROM e""")
def question_scores(spark, sf):
    """Labels in groups of five documents stand for the answers of a question."""
    p = _pred(spark, sf).withColumn("q", F.floor(F.col("doc_id") / 5))
    return M.question_scores(p, "q", "pred", "quality").select(*[F.round(c, 9).alias(c) for c in ("exact_match", "f1_m", "f1_a")])


_NORMAL_SQL = "trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '[!-/:-@\\[-`{{-~]', '', 'g'), '\\b(?:a|an|the)\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("best_answers", f"""WITH ascii AS (SELECT conv_id, turn, regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g') AS text FROM conversations WHERE text IS NOT NULL),
c AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before, substring(text, 1, 60) AS head FROM ascii),
x AS (SELECT conv_id, turn, {_NORMAL_SQL.format(x="CASE WHEN turn % 3 = 0 THEN 'The ' || head || '!' ELSE substring(text, 20, 80) END")} AS said, list_filter([head, before], lambda g: g IS NOT NULL) AS golds FROM c),
g AS (SELECT conv_id, turn, said, string_split(said, ' ') AS s, {_NORMAL_SQL.format(x="unnest(golds)")} AS gold FROM x),
w AS (SELECT *, string_split(gold, ' ') AS t FROM g),
f AS (SELECT conv_id, turn, (said = gold)::INT::DOUBLE AS em, list_sum(list_transform(list_distinct(s), lambda k: least(len(list_filter(s, lambda y: y = k)), len(list_filter(t, lambda y: y = k))))) AS same, len(s) + len(t) AS n FROM w)
SELECT conv_id, turn, max(em) AS exact_match, round(max(2.0 * same / n), 9) AS f1 FROM f GROUP BY ALL""")
def best_answers(spark, sf):
    """Exact match and word F1 against the better of one or two answers; the two engines tell words apart by different letters, hence the x."""
    from pyspark.sql import Window

    ascii_only = F.regexp_replace("text", r"[^\x00-\x7F]", "x")
    c = table(spark, sf, "conversations").where("text is not null").withColumn("text", ascii_only).withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).withColumn("head", F.substring("text", 1, 60))
    said = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("The "), "head", F.lit("!"))).otherwise(F.substring("text", 20, 80))
    em, f1 = M.best_answer(said, F.array_compact(F.array("head", "before")))
    return c.select("conv_id", "turn", em.alias("exact_match"), F.round(f1, 9).alias("f1"))


@query("slice_table", """WITH r AS (SELECT lang, source, doc_id % 9 = 0 AS failed, (doc_id % 3)::DOUBLE / 2 AS score FROM documents),
g AS (SELECT CASE WHEN grouping(source) = 1 THEN 'lang' ELSE 'source' END AS slice, coalesce(lang, source) AS name, sum((NOT failed)::INT) AS answered, sum(failed::INT) AS parse_errors, avg(CASE WHEN NOT failed THEN score END) AS avg_score, 100.0 * sum((NOT failed AND score = 1)::INT) / sum((NOT failed)::INT) AS strict_pct FROM r GROUP BY GROUPING SETS ((lang), (source)))
SELECT slice, row_number() OVER (PARTITION BY slice ORDER BY answered + parse_errors DESC, name)::INTEGER AS place, name, answered + parse_errors AS n, avg_score, strict_pct, parse_errors FROM g""")
def slice_table(spark, sf):
    """Slices of each kind, the largest first."""
    g = metric_slices(spark, sf).where(F.col("lang").isNotNull() | F.col("source").isNotNull())
    return M.slice_table(g, ["lang", "source"])


@query("few_shot_accuracy", """WITH r AS (SELECT source AS subject, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE chr((65 + doc_id % 4)::INT) END AS pred, chr((65 + doc_id % 12 % 5)::INT) AS gold FROM documents), c AS (SELECT DISTINCT subject, 'group ' || subject[-1:] AS category FROM r), j AS (SELECT category, coalesce(pred = gold, false)::INT AS ok FROM r JOIN c USING (subject))
SELECT category, round(100.0 * sum(ok) / count(*), 2) AS accuracy, count(*) AS n FROM (SELECT * FROM j UNION ALL SELECT 'Average', ok FROM j) GROUP BY 1""")
def few_shot_accuracy(spark, sf):
    """Letters taken from answers, by subject and category."""
    from kilnspark.functions import extract

    d = table(spark, sf, "documents")
    said = F.when(F.col("doc_id") % 11 == 0, "no letter here").otherwise(F.concat(F.lit("so the answer is ("), F.char(65 + F.col("doc_id") % 4), F.lit(").")))
    rows = d.select(F.col("source").alias("subject"), F.when(extract.choice(said) != "NOT_FOUND", extract.choice(said)).alias("pred"), F.char(65 + F.col("doc_id") % 12 % 5).alias("gold"))
    groups = rows.select("subject", F.concat(F.lit("group "), F.substring("subject", -1, 1)).alias("category")).distinct()
    return M.category_accuracy(rows, "subject", "pred", "gold", groups)
