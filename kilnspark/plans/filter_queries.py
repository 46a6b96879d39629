"""Queries of filters, sampling, mixing and splits over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.functions import text as X
from kilnspark.operators import balance as B
from kilnspark.operators import filters as P
from kilnspark.registry import query, table

QUALITY = r"""length(text) BETWEEN 100 AND 200000
  AND length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / length(text) >= 0.85
  AND len(regexp_extract_all(text, '[A-Za-z]{2,}')) >= 15"""


@query("filter_quality", f"SELECT doc_id FROM documents WHERE {QUALITY}")
def filter_quality(spark, sf):
    from kilnspark.operators.curate import quality_flag

    return table(spark, sf, "documents").where(quality_flag(F.col("text"))).select("doc_id")


@query("filter_recency", "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0 OR strftime(o_orderdate, '%Y-%m-%d') >= '1997-01-01'")
def filter_recency(spark, sf):
    o = table(spark, sf, "orders")
    date = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.where(P.recent(date, "1997-01-01")).select("o_orderkey")


_ID_SQL = r"list_distinct(list_transform(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Za-z]{9,}')), lambda x: upper(x)))"


@query("filter_exact_id_leak", f"""
WITH d AS (SELECT doc_id, unnest({_ID_SQL}) AS id FROM documents), b AS (SELECT DISTINCT unnest({_ID_SQL}) AS id FROM benchmark)
SELECT DISTINCT doc_id FROM d WHERE id IN (SELECT id FROM b)""")
def filter_exact_id_leak(spark, sf):
    """Identifiers are whole runs of letters, digits and underscores, so that both engines see the same word bounds."""
    from kilnspark.functions import extract as E

    # told before they are upper-cased: that turns other letters (ß, ſ, ﬁ) into A to Z
    ids = lambda c: E.ids(c, r"(?<![\p{L}\p{N}_])[A-Za-z]{9,}+(?![\p{L}\p{N}_])")
    return P.exact_id_leak(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ids)


@query("filter_present", "SELECT event_id FROM events WHERE (CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 = 2 THEN 'N/A' ELSE event_type END) NOT IN ('', 'N/A')")
def filter_present(spark, sf):
    e = F.col("event_id") % 5
    value = F.when(e == 0, None).when(e == 1, "").when(e == 2, "N/A").otherwise(F.col("event_type"))
    return table(spark, sf, "events").where(P.present(value)).select("event_id")


@query("subscript_scalar", "SELECT c_custkey FROM customer WHERE c_acctbal >= 100 AND c_mktsegment != 'BUILDING' AND contains(lower(c_mktsegment), 'ma')")
def subscript_scalar(spark, sf):
    c = table(spark, sf, "customer")
    return c.where(P.compare(F.col("c_acctbal"), ">=", 100) & P.compare(F.col("c_mktsegment"), "!=", "BUILDING") & P.compare(F.col("c_mktsegment"), "~", "MA")).select("c_custkey")


_WORDS_SQL = "string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' ')"


def _doc_words():
    return F.split(F.regexp_replace(F.lower(F.col("text")), "[^a-z]+", " "), " ")


@query("subscript_any", f"SELECT doc_id FROM documents WHERE list_contains({_WORDS_SQL}, 'the') AND NOT list_contains({_WORDS_SQL}, 'with') AND len(list_filter({_WORDS_SQL}, lambda w: contains(w, 'tion'))) > 0")
def subscript_any(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", _doc_words().alias("w"))
    return w.where(P.any_of(F.col("w"), "=", "the") & P.any_of(F.col("w"), "!=", "with") & P.any_of(F.col("w"), "~", "TION")).select("doc_id")


@query("subscript_all", f"SELECT doc_id FROM documents WHERE len(list_filter({_WORDS_SQL}, lambda w: w = 'by')) = 0 AND len(list_filter({_WORDS_SQL}, lambda w: length(w) > 40)) = 0 AND len(list_filter({_WORDS_SQL}[1:3], lambda w: NOT contains(w, 'n'))) = 0")
def subscript_all(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", _doc_words().alias("w"))
    return w.where(P.all_of(F.col("w"), "!=", "by") & F.forall("w", lambda x: F.length(x) <= 40) & P.all_of(F.slice("w", 1, 3), "~", "N")).select("doc_id")


@query("subscript_index", f"SELECT doc_id, coalesce({_WORDS_SQL}[51], 'N/A') AS word FROM documents")
def subscript_index(spark, sf):
    return table(spark, sf, "documents").select("doc_id", _doc_words().alias("w")).select("doc_id", P.element(F.col("w"), 50).alias("word"))


@query("filter_modified_window", """
SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE (o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1995-06-30') OR (l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate <= TIMESTAMP '1995-06-30') GROUP BY o_orderkey""")
def filter_modified_window(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    test = P.modified_window([F.col("o_orderdate").cast("timestamp_ntz"), F.col("l_shipdate").cast("timestamp_ntz")], "1995-01-01", "1995-06-30", "any")
    return j.where(test).select("o_orderkey").distinct()


@query("filter_tags", "SELECT doc_id, lang IN ('en', 'fr') AND source IN ('src1', 'src2', 'en', 'fr') AS all_in, (lang = 'de' OR source = 'src3') AS any_in FROM documents")
def filter_tags(spark, sf):
    tags = F.array("lang", "source")
    d = table(spark, sf, "documents")
    return d.select("doc_id", P.tags_all(tags, ["en", "fr", "src1", "src2"]).alias("all_in"), P.tags_any(tags, ["de", "src3"]).alias("any_in"))


@query("filter_eligible", "SELECT conv_id, turn FROM conversations WHERE coalesce(role, '') <> '' AND coalesce(text, '') <> '' AND length(text) >= 80")
def filter_eligible(spark, sf):
    return table(spark, sf, "conversations").where(P.eligible(F.col("role"), F.col("text"), 80)).select("conv_id", "turn")


@query("filter_single_id", r"SELECT doc_id FROM documents WHERE len(list_distinct(regexp_extract_all(text, '[0-9]{16}'))) = 1")
def filter_single_id(spark, sf):
    return table(spark, sf, "documents").where(F.size(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]{16}"), F.lit(0)))) == 1).select("doc_id")


@query("filter_min_words", r"SELECT doc_id FROM documents WHERE len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) >= 200")
def filter_min_words(spark, sf):
    return table(spark, sf, "documents").where(P.min_words(F.col("text"), 200)).select("doc_id")


@query("filter_time_window", "SELECT event_id FROM events WHERE ts BETWEEN (SELECT min(ts) FROM events) AND TIMESTAMP '2024-01-15 12:00:00'")
def filter_time_window(spark, sf):
    return table(spark, sf, "events").where(P.in_window(F.col("ts"), "0001-01-01", "2024-01-15 12:00:00")).select("event_id")


_RESP_SQL = "CASE turn % 6 WHEN 0 THEN 'Error' WHEN 1 THEN 'Error: ' || text WHEN 2 THEN 'Error generating response: x' WHEN 3 THEN 'NaN' WHEN 4 THEN '' ELSE text END"


def _response():
    t = F.col("turn") % 6
    return F.when(t == 0, "Error").when(t == 1, F.concat(F.lit("Error: "), "text")).when(t == 2, "Error generating response: x").when(t == 3, "NaN").when(t == 4, "").otherwise(F.col("text"))


@query("filter_error_rows", f"""WITH r AS (SELECT conv_id, turn, {_RESP_SQL} AS x FROM conversations)
SELECT conv_id, turn, (x = 'Error' OR starts_with(x, 'Error:') OR starts_with(x, 'Error generating response')) AS is_error,
(trim(x) = '' OR lower(trim(x)) = 'nan' OR x = 'Error' OR starts_with(x, 'Error:') OR starts_with(x, 'Error generating response')) AS refetch FROM r""")
def filter_error_rows(spark, sf):
    r = table(spark, sf, "conversations").select("conv_id", "turn", _response().alias("x"))
    return r.select("conv_id", "turn", P.is_error(F.col("x")).alias("is_error"), P.needs_refetch(F.col("x")).alias("refetch"))


@query("classify_axis", "SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{16}') THEN 'number' WHEN regexp_matches(text, '@') THEN 'mail' WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'license' ELSE 'other' END AS axis FROM documents")
def classify_axis(spark, sf):
    return table(spark, sf, "documents").select("doc_id", P.first_rule(F.col("text"), [("[0-9]{16}", "number"), ("@", "mail"), ("(?i)licen[sc]e", "license")], "other").alias("axis"))


_LIC_SQL = "CASE doc_id % 7 WHEN 0 THEN 'mit' WHEN 1 THEN 'cc-by-nc-4.0' WHEN 2 THEN 'gpl-3.0' WHEN 3 THEN 'cc-by-nc-nd-4.0' WHEN 4 THEN NULL WHEN 5 THEN 'x' ELSE 'cc0' END"


def license_tag():
    k = F.col("doc_id") % 7
    return F.when(k == 0, "mit").when(k == 1, "cc-by-nc-4.0").when(k == 2, "gpl-3.0").when(k == 3, "cc-by-nc-nd-4.0").when(k == 4, None).when(k == 5, "x").otherwise("cc0")


@query("classify_license", f"SELECT doc_id, CASE WHEN t IN ('mit','cc0') THEN 'allowed' WHEN t = 'cc-by-nc-4.0' THEN 'allowed-nc' WHEN t = 'cc-by-nc-nd-4.0' THEN 'denied-nc' WHEN t = 'gpl-3.0' THEN 'denied' ELSE 'unknown' END AS verdict FROM (SELECT doc_id, {_LIC_SQL} AS t FROM documents)")
def classify_license(spark, sf):
    return table(spark, sf, "documents").select("doc_id", P.license_verdict(license_tag()).alias("verdict"))


@query("filter_valid_example", """SELECT conv_id, n % 2 = 0 AS sft_ok, false AS pair_ok, (n - 1) % 2 = 1 AS open_ok FROM (SELECT conv_id, count(*) AS n FROM conversations WHERE role <> 'system' GROUP BY conv_id)""")
def filter_valid_example(spark, sf):
    c = table(spark, sf, "conversations").where("role <> 'system'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    p, r = F.slice("m", F.lit(1), F.size("m") - 1), F.slice("m", F.size("m"), F.lit(1))
    return c.select("conv_id", P.valid_example(p, r, "sft").alias("sft_ok"), P.valid_example(p, r, "pairwise").alias("pair_ok"), P.valid_example(p, r, "unsupervised").alias("open_ok"))


@query("keyword_categories", f"""SELECT doc_id, CAST((CASE WHEN len(list_filter(w, lambda x: starts_with(x, 'tion'))) > 0 AND len(list_filter(w, lambda x: starts_with(x, 'th'))) > 0 THEN 1 ELSE 0 END)
 + (CASE WHEN len(list_filter(w, lambda x: starts_with(x, 'ver'))) > 0 THEN 2 ELSE 0 END) AS INTEGER) AS mask FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents)""")
def keyword_categories(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", _doc_words().alias("w"))
    return w.select("doc_id", P.keyword_mask(F.col("w"), [["tion", "th"], ["ver"]]).alias("mask"))


# ------------------------------------------------------------ text functions


@query("text_functions", r"""SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n_words, len(regexp_extract_all(lower(text), '[a-z0-9_.-]+')) AS n_tokens,
 len(list_distinct(CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i+4], ' ')) ELSE [] END)) AS n_grams,
 sha1(text) AS sha1, sha256(text) AS sha256, substring(sha1(text), 1, 16) AS short_id, strlen(text) / 4.0 AS est_tokens
 FROM (SELECT *, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents)""")
def text_functions(spark, sf):
    d = table(spark, sf, "documents").withColumn("t", X.word_tokens(F.col("text")))
    grams = X.ngrams(F.col("t"), 5)
    return d.select("doc_id", F.size("t").cast("long").alias("n_words"), F.size(X.shingle_tokens(F.col("text"))).cast("long").alias("n_tokens"), F.size(F.array_distinct(grams)).cast("long").alias("n_grams"), F.sha1("text").alias("sha1"), F.sha2("text", 256).alias("sha256"), F.substring(F.sha1("text"), 1, 16).alias("short_id"), (F.octet_length("text") / 4.0).alias("est_tokens"))


# ------------------------------------------------------------ sampling and splits


def _draw_sql(seed: str, *keys: str) -> str:
    return "md5(concat_ws('|', '" + seed + "', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + "))"


@query("interleave_families", f"SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY {_draw_sql('s1', 'doc_id')}, doc_id) - 0.5) * (SELECT count(*) FROM documents) / count(*) OVER (PARTITION BY source) AS pos FROM documents")
def interleave_families(spark, sf):
    return B.interleave(table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id", "s1")


@query("interleave_check", f"""WITH p AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY {_draw_sql('s1', 'doc_id')}, doc_id) - 0.5) * (SELECT count(*) FROM documents) / count(*) OVER (PARTITION BY source) AS pos FROM documents),
r AS (SELECT source, row_number() OVER (ORDER BY pos, source) - 1 AS rn FROM p), z AS (SELECT count(*) AS m, least(512, count(*)) AS w FROM documents),
v AS (SELECT 'start' AS part, 0 AS lo, w FROM z UNION ALL SELECT 'middle', (m - w) // 2, w FROM z UNION ALL SELECT 'end', m - w, w FROM z), t AS (SELECT source, 1.0 * count(*) / (SELECT m FROM z) AS share FROM documents GROUP BY source)
SELECT part, source, count(*) AS seen, round(abs(count(*) - any_value(w * share)) / any_value(w * share), 6) AS error FROM r JOIN v ON rn >= lo AND rn < lo + w JOIN t USING (source) WHERE w * share >= 0.5 GROUP BY part, source""")
def interleave_check(spark, sf):
    """Windows of 512 rows at the start, in the middle and at the end hold each family in proportion."""
    from kilnspark.operators.numbering import numbered

    d = table(spark, sf, "documents").select("doc_id", "source")
    total = d.agg(F.count("*").alias("all")).withColumn("w", F.least(F.lit(512), "all"))
    target = d.groupBy("source").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("source", (F.col("w") * F.col("n") / F.col("all")).alias("target")).where("target >= 0.5")
    rows = numbered(B.interleave(d, "source", "doc_id", "s1"), ["pos", "source", "doc_id"], "rn").crossJoin(F.broadcast(total))
    starts = {"start": F.lit(0), "middle": F.floor((F.col("all") - F.col("w")) / 2), "end": F.col("all") - F.col("w")}
    parts = F.filter(F.array(*[F.when((F.col("rn") >= at) & (F.col("rn") < at + F.col("w")), F.lit(k)) for k, at in starts.items()]), lambda x: x.isNotNull())
    seen = rows.select("source", F.explode(parts).alias("part")).groupBy("part", "source").agg(F.count("*").alias("seen"))
    return seen.join(target, "source").select("part", "source", "seen", F.round(F.abs(F.col("seen") - F.col("target")) / F.col("target"), 6).alias("error"))


@query("cap_families", f"SELECT doc_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_draw_sql('s2', 'doc_id')}, doc_id) AS rn FROM documents) WHERE rn <= 5 OR starts_with(source, 'src1')")
def cap_families(spark, sf):
    return B.cap(table(spark, sf, "documents"), "source", "doc_id", 5, "s2", "src1").select("doc_id")


@query("uniform_sample", f"SELECT doc_id FROM documents ORDER BY {_draw_sql('s3', 'doc_id')}, doc_id LIMIT 100")
def uniform_sample(spark, sf):
    return B.sample(table(spark, sf, "documents").select("doc_id"), "doc_id", 100, "s3")


@query("two_caps", f"""WITH a AS (SELECT doc_id, lang, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE source END AS actor FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY lang, actor ORDER BY {_draw_sql('s4', 'doc_id')}, doc_id) AS rn FROM a),
y AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_draw_sql('s4', 'doc_id')}, doc_id) AS rf FROM x WHERE actor IS NULL OR rn <= 4) SELECT doc_id, lang FROM y WHERE rf <= 50""")
def two_caps(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 11 != 0, F.col("source")).alias("actor"))
    return B.two_caps(a, "actor", "lang", "doc_id", 4, 50, "s4").select("doc_id", "lang")


@query("validation_slice", f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {_draw_sql('s5', 'doc_id')}, doc_id) <= 50 THEN 'val' ELSE 'train' END AS split FROM documents")
def validation_slice(spark, sf):
    return B.validation_slice(table(spark, sf, "documents"), "lang", "doc_id", 50, "s5").select("doc_id", "split")


@query("mini_subset", f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY {_draw_sql('s6', 'doc_id')}, doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE rn <= greatest(1, ceil(0.03 * n))")
def mini_subset(spark, sf):
    return B.fraction(table(spark, sf, "documents"), "lang", "doc_id", 0.03, "s6").select("doc_id")


@query("answer_subset", f"SELECT doc_id FROM (SELECT doc_id FROM labels WHERE toxic = 0 ORDER BY {_draw_sql('s7', 'doc_id')}, doc_id LIMIT 60)")
def answer_subset(spark, sf):
    return B.sample(table(spark, sf, "labels").where("toxic = 0").select("doc_id"), "doc_id", 60, "s7").orderBy("doc_id")


@query("resample_to", f"""WITH r AS (SELECT item_id, row_number() OVER (ORDER BY {_draw_sql('s8', 'item_id')}, item_id) AS rn, (SELECT count(*) FROM benchmark) AS n FROM benchmark)
SELECT item_id, CAST(unnest(range(0, CAST(floor(130 / n) + CASE WHEN rn <= 130 % n THEN 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS copy FROM r""")
def resample_to(spark, sf):
    return B.resample(table(spark, sf, "benchmark").select("item_id"), "item_id", 130, "s8")


@query("max_samples", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50")
def max_samples(spark, sf):
    return table(spark, sf, "documents").select("doc_id").orderBy("doc_id").limit(50)


@query("index_selection", "SELECT doc_id FROM documents WHERE doc_id >= 10 AND doc_id < 40 UNION ALL SELECT doc_id FROM documents WHERE doc_id IN (100, 150, 199)")
def index_selection(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return d.where("doc_id >= 10 and doc_id < 40").union(d.where(F.col("doc_id").isin(100, 150, 199)))


_MIX_SQL = """WITH slots AS (SELECT range AS slot FROM range(400)), h AS (SELECT slot, CAST(('0x' || substring(md5('m1|' || CAST(slot AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM slots),
c AS (SELECT slot, CASE WHEN u < 0.4 THEN 'en' WHEN u < 0.7 THEN 'fr' WHEN u < 0.9 THEN 'de' ELSE 'es' END AS dataset FROM h), t AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY slot) - 1 AS turn FROM c),
r AS (SELECT lang AS dataset, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT slot, t.dataset, doc_id FROM t JOIN (SELECT DISTINCT dataset, n FROM r) s ON t.dataset = s.dataset JOIN r ON r.dataset = t.dataset AND r.at = t.turn % s.n"""


@query("mix_interleave", _MIX_SQL)
def mix_interleave(spark, sf):
    d = table(spark, sf, "documents")
    return B.mix_interleave({k: d.where(F.col("lang") == k) for k in ("en", "fr", "de", "es")}, {"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}, "doc_id", 400, "m1")


@query("mix_concat", "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def mix_concat(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("corpus_merge", "SELECT doc_id, text, NULL AS item_id FROM documents UNION ALL SELECT NULL, text, item_id FROM benchmark")
def corpus_merge(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text").unionByName(table(spark, sf, "benchmark"), allowMissingColumns=True)


@query("train_val_split", f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_draw_sql('v1', 'doc_id')}, doc_id) <= 40 THEN 'val' ELSE 'train' END AS split FROM documents")
def train_val_split(spark, sf):
    return B.train_val(table(spark, sf, "documents").select("doc_id"), "doc_id", 40, "v1")


@query("train_val_share", f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_draw_sql('v2', 'doc_id')}, doc_id) <= floor(0.15 * (SELECT count(*) FROM documents)) THEN 'val' ELSE 'train' END AS split FROM documents")
def train_val_share(spark, sf):
    return B.train_val(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.15, "v2")


_DRAWN = "CAST(floor(CAST('0x' || substring(md5(concat_ws('|', '{seed}', CAST({k} AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0 * {n}) AS BIGINT)"


@query("resample_drawn", f"""WITH r AS (SELECT item_id, row_number() OVER (ORDER BY {_draw_sql('s9', 'item_id')}, item_id) - 1 AS draw FROM benchmark), k AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS p FROM benchmark), n AS (SELECT count(*) AS n FROM benchmark),
x AS (SELECT range + n AS draw, {_DRAWN.format(seed='s9', k='range + n', n='n')} AS p FROM range(0, 90), n) SELECT draw, item_id FROM r UNION ALL SELECT draw, item_id FROM x JOIN k USING (p)""")
def resample_drawn(spark, sf):
    """All rows in drawn order, then 90 more with replacement."""
    b = table(spark, sf, "benchmark").select("item_id")
    return B.resample_drawn(b, "item_id", b.count() + 90, "s9")


@query("resample_weighted", f"""WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents), n AS (SELECT count(*) AS n FROM documents), x AS (SELECT {_DRAWN.format(seed='w2w', k='range', n='n')} AS p FROM n, range(0, CAST(floor(n.n * 1.5) AS BIGINT)))
SELECT doc_id, count(*) AS n FROM x JOIN k USING (p) GROUP BY doc_id""")
def resample_weighted(spark, sf):
    return B.resample_weighted(table(spark, sf, "documents").select("doc_id"), "doc_id", "w2", weight=1.5).groupBy("doc_id").agg(F.count("*").alias("n"))


_UNTIL = """WITH c AS (SELECT range AS slot, CAST('0x' || substring(md5('m2|' || range), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM range(0, 20 * (SELECT count(*) FROM documents))),
t AS (SELECT slot, dataset, row_number() OVER (PARTITION BY dataset ORDER BY slot) - 1 AS turn FROM (SELECT slot, CASE WHEN u < 0.4 THEN 'en' WHEN u < 0.7 THEN 'fr' WHEN u < 0.9 THEN 'de' ELSE 'es' END AS dataset FROM c)),
r AS (SELECT lang AS dataset, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at, count(*) OVER (PARTITION BY lang) AS n FROM documents),
s AS (SELECT t.*, n FROM t JOIN (SELECT DISTINCT dataset, n FROM r) USING (dataset)), e AS (SELECT slot FROM s WHERE turn = n - 1)
SELECT s.slot, s.dataset, r.doc_id FROM s JOIN r ON r.dataset = s.dataset AND r.at = s.turn % s.n WHERE {rule}"""


def _mix_until(spark, sf, stop):
    d = table(spark, sf, "documents")
    return B.mix_until({k: d.where(F.col("lang") == k) for k in ("en", "fr", "de", "es")}, {"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}, "doc_id", "m2", stop)


@query("mix_under", _UNTIL.format(rule="s.slot <= (SELECT min(slot) FROM e)"))
def mix_under(spark, sf):
    return _mix_until(spark, sf, "under")


@query("mix_over", _UNTIL.format(rule="s.slot <= (SELECT max(slot) FROM e)"))
def mix_over(spark, sf):
    return _mix_until(spark, sf, "over")


@query("mix_once", _UNTIL.format(rule="s.turn < s.n"))
def mix_once(spark, sf):
    return _mix_until(spark, sf, "once")


@query("split_three", "SELECT doc_id, CASE WHEN source IN ('src1', 'src10') THEN 'c' WHEN starts_with(source, 'src1') THEN 'b' ELSE 'broad' END AS shard FROM documents WHERE source NOT IN ('src1', 'src10')")
def split_three(spark, sf):
    """Precedence C, B, broad; C has no output path here and is dropped."""
    s = F.col("source")
    name = F.when(s.isin("src1", "src10"), "c").when(s.startswith("src1"), "b").otherwise("broad")
    return B.shard(table(spark, sf, "documents"), name).where("shard <> 'c'").select("doc_id", "shard")


@query("split_two", "SELECT doc_id, unnest(CASE WHEN source = 'src3' THEN ['a', 'b'] WHEN starts_with(source, 'src1') THEN ['b'] ELSE ['a'] END) AS shard FROM documents")
def split_two(spark, sf):
    s = F.col("source")
    shards = F.when(s == "src3", F.array(F.lit("a"), F.lit("b"))).when(s.startswith("src1"), F.array(F.lit("b"))).otherwise(F.array(F.lit("a")))
    return table(spark, sf, "documents").select("doc_id", F.explode(shards).alias("shard"))


@query("split_four", "SELECT doc_id, CASE WHEN source = 'src1' THEN 'one' WHEN starts_with(source, 'src1') THEN 'two' WHEN lang = 'fr' OR lang = 'de' THEN 'three' ELSE 'broad' END AS shard FROM documents")
def split_four(spark, sf):
    s = F.col("source")
    name = F.when(s == "src1", "one").when(s.startswith("src1"), "two").when(F.col("lang").isin("fr", "de"), "three").otherwise("broad")
    return B.shard(table(spark, sf, "documents"), name).select("doc_id", "shard")


@query("distinct_pairs", "SELECT DISTINCT lang, text FROM documents")
def distinct_pairs(spark, sf):
    return table(spark, sf, "documents").select("lang", "text").distinct()


@query("set_difference", "SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_nationkey < 12")
def set_difference(spark, sf):
    return table(spark, sf, "orders").select("o_custkey").subtract(table(spark, sf, "customer").where("c_nationkey < 12").select("c_custkey"))


@query("set_intersection", "SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey < 12")
def set_intersection(spark, sf):
    return table(spark, sf, "orders").select("o_custkey").intersect(table(spark, sf, "customer").where("c_nationkey < 12").select("c_custkey"))


@query("dedupe_urls", "SELECT url, min(page_id) AS page_id FROM pages WHERE page_id % 9 <> 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 9 = 0) GROUP BY url")
def dedupe_urls(spark, sf):
    """First page of each URL that is not written yet."""
    p = table(spark, sf, "pages")
    written = p.where("page_id % 9 = 0").select("url")
    return p.where("page_id % 9 <> 0").join(written, "url", "left_anti").groupBy("url").agg(F.min("page_id").alias("page_id"))
