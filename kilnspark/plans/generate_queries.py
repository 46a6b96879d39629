"""Queries of renderers, builders and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.operators import build as U
from kilnspark.operators import generate as N
from kilnspark.operators import render as D
from kilnspark.plans.metric_queries import uuid5_sql
from kilnspark.registry import query, table


@query("render_stix", "SELECT c_custkey AS id, 'tool' AS type, 'S' || c_custkey || ' ' || c_name || ' | Aliases: ' || c_mktsegment || ' | Tactics: lateral movement' || chr(10) || 'about ' || c_name AS text FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0")
def render_stix(spark, sf):
    c = table(spark, sf, "customer")
    objects = c.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 7 == 0, "identity").otherwise("tool").alias("type"), F.col("c_name").alias("name"), F.concat(F.lit("about "), "c_name").alias("description"),
        (F.col("c_custkey") % 5 == 0).alias("revoked"), F.lit(None).cast("boolean").alias("x_mitre_deprecated"), F.array("c_mktsegment").alias("aliases"), F.array().cast("array<string>").alias("x_mitre_platforms"),
        F.array(F.struct(F.lit("mitre-attack").alias("kill_chain_name"), F.lit("lateral-movement").alias("phase_name")), F.struct(F.lit("other").alias("kill_chain_name"), F.lit("x").alias("phase_name"))).alias("kill_chain_phases"),
        F.array(F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("external_id"))).alias("external_references"),
    )
    return D.stix_documents(objects)


@query("render_kev", "SELECT 'CVE-2024-' || s_suppkey AS id, '2024-01-01' AS date, 'CVE-2024-' || s_suppkey || ' | ' || s_name || ' | acme box' || chr(10) || 'short' || chr(10) || 'Action: patch' || CASE WHEN s_suppkey % 2 = 0 THEN chr(10) || 'Known ransomware use.' ELSE '' END AS text FROM supplier WHERE s_suppkey % 3 <> 0")
def render_kev(spark, sf):
    s = table(spark, sf, "supplier")
    rows = s.select(F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("CVE-2024-"), F.col("s_suppkey").cast("string"))).alias("cveID"), F.col("s_name").alias("vulnerabilityName"), F.lit("acme").alias("vendorProject"), F.lit("box").alias("product"), F.lit("short").alias("shortDescription"), F.lit("patch").alias("requiredAction"), F.when(F.col("s_suppkey") % 2 == 0, "Known").otherwise("Unknown").alias("knownRansomwareCampaignUse"), F.lit("2024-01-01").alias("dateAdded"))
    return D.kev_documents(rows)


@query("build_exploit_edges", "SELECT DISTINCT o_orderkey AS src, unnest(['CVE-2024-' || o_orderkey, 'CVE-2025-1']) AS dst FROM orders")
def build_exploit_edges(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("cve-2024-"), F.col("o_orderkey").cast("string"), F.lit(";CVE-2019-5, CVE-2025-1;OSVDB-3")).alias("codes"))
    return U.exploit_edges(o)


@query("build_rule_techniques", "SELECT DISTINCT p_partkey AS src, n_nationkey AS dst FROM part JOIN nation ON p_partkey % 30 = n_nationkey")
def build_rule_techniques(spark, sf):
    rules = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.array(F.format_string("attack.t10%02d.%d", F.col("p_partkey") % 30, F.lit(7)), F.lit("car.2013")).alias("tags"))
    tech = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.format_string("T10%02d.007", "n_nationkey").alias("mitre_id"))
    return U.rule_techniques(rules, tech)


@query("build_entity_ids", f"SELECT n_nationkey, {uuid5_sql('n_name')} AS stix_id FROM nation")
def build_entity_ids(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", U.entity_id("example.org", F.col("n_name")).alias("stix_id"))


@query("normalise_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' AS plain, strftime(o_orderdate, '%Y-%m-%d') || 'T10:30:00' AS spaced, 'N/A' AS missing FROM orders")
def normalise_dates(spark, sf):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", D.iso_date(d).alias("plain"), D.iso_date(F.concat(d, F.lit(" 10 : 30:00"))).alias("spaced"), D.iso_date(F.lit(" ")).alias("missing"))


@query("shuffle_options", "WITH r AS (SELECT item_id, unnest([0, 1, 2, 3, 4]) AS i FROM benchmark), s AS (SELECT item_id, i, row_number() OVER (PARTITION BY item_id ORDER BY md5('q|' || item_id || '|' || i)) AS pos FROM r) SELECT item_id, string_agg('option ' || i, ';' ORDER BY pos) AS shuffled, chr(CAST(64 + max(CASE WHEN i = item_id % 5 THEN pos END) AS INT)) AS letter FROM s GROUP BY item_id")
def shuffle_options(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", F.array(*[F.lit(f"option {i}") for i in range(5)]).alias("o"), (F.col("item_id") % 5).alias("a"))
    return N.shuffle_options(b, "item_id", "o", "a", "q").select("item_id", F.array_join("shuffled", ";").alias("shuffled"), "letter")


_SUBSETS_SQL = """WITH m AS (SELECT range AS mask, bit_count(range) AS size FROM range(1, {top})), b AS (SELECT mask, size, row_number() OVER (PARTITION BY size ORDER BY mask) - 1 AS number, count(*) OVER (PARTITION BY size) AS n FROM m WHERE size <= 3),
d AS (SELECT n_nationkey, size, (CAST('0x' || substring(md5('a|' || n_nationkey || '|' || size), 1, 13) AS BIGINT) + i * 2147483647) % n AS number FROM nation, (SELECT DISTINCT size, n FROM b), range({cap}) t(i) WHERE i < n)
SELECT n_nationkey, CAST(d.size AS INT) AS size, array_to_string(list_transform(list_filter(range({n}), lambda i: (mask >> i) & 1 = 1), lambda i: 'a' || i), ',') AS subset FROM d JOIN b ON b.size = d.size AND b.number = d.number"""


def _subsets(spark, sf, n, cap):
    rows = table(spark, sf, "nation").select("n_nationkey", F.array(*[F.lit(f"a{i}") for i in range(n)]).alias("aliases"))
    return N.alias_subsets(rows, "n_nationkey", "aliases", 3, cap, "a").select("n_nationkey", "size", F.array_join("subset", ",").alias("subset"))


@query("alias_subsets", _SUBSETS_SQL.format(top=32, cap=7, n=5))
def alias_subsets(spark, sf):
    """Lists of 5 aliases: all subsets of one, seven of the ten of two and of three."""
    return _subsets(spark, sf, 5, 7)


@query("alias_subsets_long", _SUBSETS_SQL.format(top=1 << 16, cap=40, n=16))
def alias_subsets_long(spark, sf):
    """Lists of 16 aliases: forty different subsets of two and of three."""
    return _subsets(spark, sf, 16, 40)


@query("hard_negatives", "WITH g AS (SELECT DISTINCT c_mktsegment AS foil FROM customer), k AS (SELECT foil, row_number() OVER (ORDER BY md5('h|' || foil), foil) - 1 AS ix FROM g), t AS (SELECT count(*) AS n FROM g) SELECT DISTINCT c_name, c_mktsegment, f.foil FROM customer JOIN k o ON o.foil = c_mktsegment, t, range(1, 4) s JOIN k f ON f.ix = (o.ix + s.range) % t.n")
def hard_negatives(spark, sf):
    return N.hard_negatives(table(spark, sf, "customer").select("c_name", "c_mktsegment"), "c_name", "c_mktsegment", 3, "h")


@query("phrase_facts", "SELECT n_name AS \"left\", r_name AS \"right\", form, CASE form WHEN 'where' THEN 'Where is ' || n_name || '?' ELSE 'Which lies in ' || r_name || '?' END AS question FROM nation JOIN region ON r_regionkey = n_regionkey, (SELECT unnest(['where', 'which']) AS form)")
def phrase_facts(spark, sf):
    f = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("left"), F.col("r_name").alias("right"))
    return N.phrasings(f, {"where": "Where is {left}?", "which": "Which lies in {right}?"})


@query("rotated_cards", "SELECT item_id, CAST(copy AS INT) AS copy, CASE copy WHEN 0 THEN 'a,b,c' WHEN 1 THEN 'b,c,a' ELSE 'c,a,b' END AS techniques FROM benchmark, (SELECT unnest([0, 1, 2]) AS copy)")
def rotated_cards(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("techniques"))
    return N.rotate(b, "item_id", "techniques", 3).select("item_id", "copy", F.array_join("techniques", ",").alias("techniques"))


@query("parse_options", "SELECT item_id, 'first' AS a, 'second' || chr(10) || 'more' AS b, CASE WHEN item_id % 2 = 0 THEN 'B' ELSE 'A' END AS letter FROM benchmark")
def parse_options(spark, sf):
    text = F.lit("A) first\nB) second\nmore\n")
    b = table(spark, sf, "benchmark").select("item_id", N.parse_options(text).alias("o"), N.answer_letter(F.when(F.col("item_id") % 2 == 0, "so it is. Therefore, B.").otherwise("unclear")).alias("letter"))
    return b.select("item_id", F.get("o", F.lit(0)).alias("a"), F.get("o", F.lit(1)).alias("b"), "letter")


@query("canonical_items", """WITH a AS (SELECT n_name AS grp, s_name AS alias FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT n_name, ' ' || lower(n_name) FROM nation), d AS (SELECT grp, arg_min(alias, struct_pack(h := md5('c|' || grp || '|' || alias), a := alias)) AS alias FROM a WHERE lower(trim(alias)) <> lower(grp) GROUP BY grp)
SELECT grp, alias, 'Who is ' || alias || '? Name the group.' AS prompt, sha256('Who is ' || alias || '? Name the group.') AS prompt_hash FROM d""")
def canonical_items(spark, sf):
    """Groups with an alias other than their own name."""
    n = table(spark, sf, "nation")
    a = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("grp"), F.col("s_name").alias("alias"))
    return N.canonical_items(a.union(n.select("n_name", F.concat(F.lit(" "), F.lower("n_name")))), "grp", "alias", "Who is {alias}? Name the group.", "c")


@query("valid_variants", "SELECT min(doc_id) AS doc_id FROM documents WHERE length(text) BETWEEN 100 AND 3000 AND NOT contains(lower(text), 'license') AND doc_id % 7 <> 0 GROUP BY sha1(text)")
def valid_variants(spark, sf):
    d = table(spark, sf, "documents").withColumn("o", F.when(F.col("doc_id") % 7 == 0, " ").otherwise("yes"))
    return N.valid_variants(d, "doc_id", "text", "o", 100, 3000, ["License"]).select("doc_id")


@query("task_prompts", """WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey FROM customer)
SELECT 'rcm' AS task, 'CVE-' || k AS id, 'Give {id} for: a ' || c_mktsegment || '.' AS prompt, 'CWE-' || c_nationkey AS answer FROM c WHERE k % 3 <> 0
UNION ALL SELECT 'vsp', 'CVE-' || k, 'Score a ' || c_mktsegment, 'V' || k FROM c WHERE k % 4 <> 0
UNION ALL SELECT 'rms', 'T' || k, CASE WHEN k % 2 = 0 THEN 'Linux' ELSE 'Enterprise' END || ' needs 2: ' || c_name, 'M' || k || ', M0' FROM c
UNION ALL SELECT 'ate', 'T' || k, CASE WHEN k % 2 = 0 THEN 'Linux' ELSE 'Enterprise' END || ' saw ' || c_name, 'T' || k FROM c
UNION ALL SELECT 'taa', 'u' || k, 'Who? ' || CASE WHEN k % 2 = 0 THEN 'did ' || c_mktsegment ELSE c_name END, 'actor ' || c_nationkey FROM c WHERE k % 7 <> 1
UNION ALL SELECT 'mcq', 'q' || k, CASE WHEN k % 5 = 0 THEN 'given' ELSE 'Pick. Question: ' || c_name || '?' || chr(10) || 'A) one' || chr(10) || 'B) two' || chr(10) || 'C) 3. three' || chr(10) || 'D) four' || chr(10) || 'E) ' || c_mktsegment END, CASE WHEN k % 5 = 0 THEN NULL ELSE 'C' END FROM c""")
def task_prompts(spark, sf):
    """All six tasks over the customers."""
    from kilnspark.operators import tasks as J

    k = F.col("c_custkey")
    key = lambda p: F.concat(F.lit(p), k.cast("string"))
    c = table(spark, sf, "customer")
    text = F.concat(F.lit(" a\n"), "c_mktsegment", F.lit(" "))
    nation = F.col("c_nationkey").cast("string")
    cve = c.select(key("CVE-").alias("cve_id"), text.alias("description"), F.when(k % 3 == 0, F.array(F.lit("CWE-1"), F.lit("CWE-2"))).otherwise(F.array(F.concat(F.lit("CWE-"), nation), F.lit("NVD-none"), F.concat(F.lit("CWE-"), nation))).alias("weaknesses"), F.lit(1.0).alias("score"), F.lit("LOW").alias("severity"), F.when(k % 4 != 0, key("V")).alias("vector"))
    tech = c.select(key("T").alias("technique_id"), F.lit("d").alias("description"), F.when(k % 2 == 0, "Linux").alias("platform"), F.array(key("M"), F.lit("M0")).alias("mitigations"), F.col("c_name").alias("scenario"))
    seen = c.select(key("u").alias("url"), F.when(k % 2 == 0, F.concat(F.lit("did "), "c_mktsegment")).alias("actions"), F.when(k % 7 != 1, F.col("c_name")).alias("description"), F.concat(F.lit("actor "), nation).alias("actor")).where((k % 7 != 1) | (k % 2 != 0))
    quiz = c.select(key("q").alias("id"), F.concat("c_name", F.lit("?")).alias("question"), F.lit("A) one").alias("option_a"), F.lit("B. two").alias("option_b"), F.lit("C) 3. three").alias("option_c"), F.lit(" four").alias("option_d"), F.col("c_mktsegment").alias("option_e"), F.when(k % 5 == 0, "given").alias("prompt"), F.lit(" c) three").alias("correct_answer"), F.lit(None).cast("string").alias("answer"))
    made = {
        "rcm": J.BUILDERS["rcm"](cve, "Give {{id}} for: {}.").withColumnRenamed("cve_id", "id"), "vsp": J.BUILDERS["vsp"](cve, "Score {}").withColumnRenamed("cve_id", "id"),
        "rms": J.BUILDERS["rms"](tech, "{} needs {}: {}").withColumnRenamed("technique_id", "id"), "ate": J.BUILDERS["ate"](tech, "{} saw {}").withColumnRenamed("technique_id", "id"),
        "taa": J.BUILDERS["taa"](seen, "Who? {}").withColumnRenamed("url", "id"), "mcq": J.BUILDERS["mcq"](quiz, "Pick. {}"),
    }
    out = None
    for task, rows in made.items():
        part = rows.select(F.lit(task).alias("task"), "id", "prompt", "answer")
        out = part if out is None else out.unionByName(part)
    return out


@query("fact_questions", """WITH f AS (SELECT n_name AS "left", r_name AS "right" FROM nation JOIN region ON r_regionkey = n_regionkey),
r AS (SELECT v, row_number() OVER (ORDER BY md5('fq|' || v), v) - 1 AS spot, count(*) OVER () AS n FROM (SELECT DISTINCT "right" AS v FROM f)), l AS (SELECT v, row_number() OVER (ORDER BY md5('fq|' || v), v) - 1 AS spot, count(*) OVER () AS n FROM (SELECT DISTINCT "left" AS v FROM f)),
x AS (SELECT f.*, form, o.v, f."right" AS answer FROM f JOIN r a ON a.v = f."right", range(5) s(step), (SELECT unnest(['where', 'region of']) AS form) JOIN r o ON true WHERE step < a.n AND o.spot = (a.spot + step) % a.n
  UNION ALL SELECT f.*, 'which', o.v, f."left" FROM f JOIN l a ON a.v = f."left", range(5) s(step) JOIN l o ON true WHERE step < a.n AND o.spot = (a.spot + step) % a.n),
g AS (SELECT "left", "right", form, answer, list(v ORDER BY md5('fq|' || "left" || '|' || "right" || '|' || form || '|' || v)) AS options FROM x GROUP BY ALL)
SELECT "left", "right", form, CASE form WHEN 'where' THEN 'Where is ' || "left" || '?' WHEN 'region of' THEN 'Region of ' || "left" || ':' ELSE 'Which lies in ' || "right" || '?' END AS question, array_to_string(options, ';') AS options, chr((64 + list_position(options, answer))::INT) AS letter FROM g""")
def fact_questions(spark, sf):
    """Nations and their regions asked both ways, the options drawn."""
    from kilnspark.operators import tasks as J

    facts = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_name").alias("left"), F.col("r_name").alias("right"))
    found = J.fact_questions(facts, {"where": "Where is {left}?", "region of": "Region of {left}:"}, {"which": "Which lies in {right}?"}, "fq")
    return found.withColumn("options", F.array_join("options", ";"))


@query("cluster_rows", """WITH a AS (SELECT 'u' || s_suppkey AS uuid, trim(s_name) AS name, list_filter(['Alias ' || s_suppkey, 'shared', 'x', lower(s_name)], lambda s: length(s) >= 3 AND lower(s) <> lower(s_name)) AS syn, CASE s_nationkey % 3 WHEN 0 THEN 'Norway' WHEN 1 THEN 'SE' ELSE '' END AS country FROM supplier),
card AS (SELECT uuid, 'Name: ' || name || '. Country: ' || CASE country WHEN '' THEN 'not documented' ELSE country END || '. Synonyms: ' || array_to_string(syn, ', ') || '.' AS output, 'CANON.2' AS shortname FROM a),
subset AS (SELECT uuid, 'Therefore, the actor is ' || name || CASE country WHEN '' THEN '' ELSE ' (' || country || ')' END || '.' AS output, 'CANON.1' AS shortname FROM a, range(3)),
k AS (SELECT uuid, name, row_number() OVER (ORDER BY md5('cl|' || uuid), uuid) - 1 AS spot, count(*) OVER () AS n FROM a),
claim AS (SELECT o.uuid, 'Reject. "Alias ' || substr(o.uuid, 2) || '" is no name of ' || f.name || '; it belongs to ' || o.name || '.' AS output, 'CANON.3' AS shortname FROM k o, range(1, 6) s(step) JOIN k f ON true WHERE f.spot = (o.spot + step) % o.n AND step < o.n)
SELECT * FROM card UNION ALL SELECT * FROM subset UNION ALL SELECT * FROM claim""")
def cluster_rows(spark, sf):
    """Suppliers as actors with a synonym of their own, one that all share, one too short and one that is the name."""
    from kilnspark.operators import clusters as U

    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    country = F.when(F.col("s_nationkey") % 3 == 0, " no").when(F.col("s_nationkey") % 3 == 1, "SE")
    value = F.struct(F.col("s_name").alias("value"), F.concat(F.lit("u"), key).alias("uuid"), F.struct(F.array(F.concat(F.lit(" Alias "), key), F.lit("shared"), F.lit("SHARED"), F.lit("x"), F.lower("s_name")).alias("synonyms"), country.alias("country")).alias("meta"))
    known = U.actors(s.select(F.lit("actors").alias("type"), F.array(value).alias("values")), {"NO": "Norway"})
    rows = U.card_rows(known, "cl").unionByName(U.subset_rows(known, "cl")).unionByName(U.rejection_rows(known, "cl"))
    return rows.select("uuid", "output", "shortname")
