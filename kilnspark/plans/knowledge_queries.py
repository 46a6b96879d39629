"""Queries of the knowledge-graph builders: source files are written from the driver's tables and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.operators import knowledge as N
from kilnspark.registry import query, table
from kilnspark.sources.workspace import folder


def _json(spark, rows, schema):
    """Rows through JSON lines of the given schema."""
    path = folder(spark)
    rows.write.json(path)
    return spark.read.schema(schema).json(path)


def _xml(spark, rows, tag, schema):
    path = folder(spark)
    rows.write.format("xml").option("rowTag", tag).save(path)
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def _key(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _cves(spark, sf):
    """One record for each part; every fourth is of an early year."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    year = F.when(k % 4 == 0, "CVE-2019-").otherwise("CVE-2024-")
    text = lambda v: F.array(F.struct(v.alias("value")))
    cna = F.struct(
        F.when(k % 3 != 0, F.col("p_name")).alias("title"), text(F.col("p_name")).alias("descriptions"), F.array(F.struct(F.lit("v").alias("vendor"), F.col("p_brand").alias("product"))).alias("affected"),
        F.when(k % 2 == 0, F.array(F.struct(F.struct(F.lit("NETWORK").alias("attackVector"), (k % 10).cast("double").alias("baseScore"), F.lit("AV:N").alias("vectorString")).alias("cvssV3_1")))).alias("metrics"),
        F.array(F.struct(F.lit("").alias("description")), F.struct(F.col("p_type").alias("description"))).alias("workarounds"),
        F.array(F.struct(F.when(k % 2 == 0, _key("CAPEC-", "p_size")).otherwise(F.col("p_size").cast("string")).alias("capecId"))).alias("impacts"),
        F.array(F.struct(F.array(F.struct(_key("CWE-", "p_size").alias("cweId"), F.repeat("p_name", F.lit(20)).alias("description")), F.struct(F.lit(None).cast("string").alias("cweId"), F.lit("x").alias("description"))).alias("descriptions"))).alias("problemTypes"),
    )
    rows = p.select(F.struct(F.concat(year, k.cast("string")).alias("cveId"), F.lit("2024-05-01").alias("datePublished")).alias("cveMetadata"), F.struct(cna.alias("cna")).alias("containers"))
    return _json(spark, rows, N.CVE_SCHEMA)


_CVE = "CASE WHEN p_partkey % 4 = 0 THEN 'CVE-2019-' ELSE 'CVE-2024-' END || p_partkey"


@query("build_cve_nodes", f"""SELECT {_CVE} AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name ELSE 'N/A' END AS title, [p_name] AS descriptions, [p_brand] AS affected_products, CASE WHEN p_partkey % 2 = 0 THEN 'NETWORK' ELSE 'N/A' END AS attack_vector, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 10)::DOUBLE END AS base_score, [p_type] AS workarounds,
CASE WHEN p_partkey % 5 = 0 THEN '[{{"criteria":"cpe:' || p_partkey || '","vulnerable":true,"versionEndIncluding":"' || p_size || '"}}]' ELSE '[]' END AS cpe_matches FROM part WHERE p_partkey % 4 <> 0""")
def build_cve_nodes(spark, sf):
    p = table(spark, sf, "part").where("p_partkey % 5 = 0")
    match = F.struct(_key("cpe:", "p_partkey").alias("criteria"), F.lit(True).alias("vulnerable"), F.col("p_size").cast("string").alias("versionEndIncluding"), F.lit("x").alias("other"))
    empty = F.struct(F.lit(None).cast("string").alias("criteria"), F.lit(False).alias("vulnerable"), F.lit("0").alias("versionEndIncluding"), F.lit("x").alias("other"))
    nvd = p.select(F.struct(_key("CVE-2024-", "p_partkey").alias("id"), F.array(F.struct(F.array(F.struct(F.array(empty, match).alias("cpeMatch"))).alias("nodes"))).alias("configurations")).alias("cve"))
    nodes = N.cve_nodes(_cves(spark, sf), N.cpe_index(_json(spark, nvd, N.NVD_SCHEMA)))
    return nodes.select("id", "title", "descriptions", "affected_products", "attack_vector", "base_score", "workarounds", "cpe_matches")


@query("build_cve_edges", f"""SELECT 'impacts' AS kind, {_CVE} AS src, 'CAPEC-' || p_size AS dst, '' AS description FROM part UNION ALL SELECT 'problem', {_CVE}, 'CWE-' || p_size, '' FROM part
UNION ALL SELECT 'observed', 'CWE-' || p_size, {_CVE}, substr(repeat(p_name, 20), 1, 200) FROM part""")
def build_cve_edges(spark, sf):
    c = _cves(spark, sf)
    none = F.lit("").alias("description")
    return N.cve_impacts(c).select(F.lit("impacts").alias("kind"), "src", "dst", none).union(N.cve_problems(c).select(F.lit("problem"), "src", "dst", none)).union(N.weakness_observed(c).select(F.lit("observed"), "src", "dst", "description"))


@query("build_kev", """SELECT 'node' AS kind, 'CVE-2024-' || s_suppkey AS src, s_name AS dst FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'for_CVE', 'CVE-2024-' || s_suppkey, 'CVE-2024-' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'weakness_known_exploit', 'CWE-' || s_nationkey, 'CVE-2024-' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0""")
def build_kev(spark, sf):
    s = table(spark, sf, "supplier")
    rows = _json(spark, s.select(F.when(F.col("s_suppkey") % 3 != 0, _key("CVE-2024-", "s_suppkey")).alias("cveID"), F.col("s_name").alias("product"), F.array(F.concat(F.lit(" CWE-"), F.col("s_nationkey").cast("string")), F.lit("")).alias("cwes")), N.KEV_SCHEMA)
    edges = N.kev_edges(rows)
    out = N.kev_nodes(rows).where("vendorProject = 'N/A'").select(F.lit("node").alias("kind"), F.col("id").alias("src"), F.col("product").alias("dst"))
    for k in ("for_CVE", "weakness_known_exploit"):
        out = out.union(edges[k].select(F.lit(k), "src", "dst"))
    return out


@query("build_epss", "SELECT 'CVE-2025-' || s_suppkey AS id, (s_suppkey % 7) / 8.0 AS epss, CASE WHEN s_suppkey % 5 <> 0 THEN 0.25 END AS percentile FROM supplier WHERE s_suppkey % 2 = 1")
def build_epss(spark, sf):
    """A file with a comment before its header; early years and missing scores among its rows."""
    s = table(spark, sf, "supplier")
    lines = s.select(F.concat(F.when(F.col("s_suppkey") % 2 == 1, "CVE-2025-").otherwise("CVE-2020-"), F.col("s_suppkey").cast("string"), F.lit(","), (F.col("s_suppkey") % 7 / 8).cast("string"), F.lit(","), F.when(F.col("s_suppkey") % 5 == 0, "N/A").otherwise("0.25")).alias("value"))
    path = folder(spark)
    spark.createDataFrame([("#model_version:v1",), ("cve,epss,percentile",)], "value string").coalesce(1).union(lines).write.text(path)
    rows = spark.read.option("comment", "#").schema("cve string, epss string, percentile string").csv(path)
    return N.epss_nodes(rows)


@query("build_proofs", """SELECT 'POC-' || n_name || '-' || n_nationkey AS id, 'https://x/' || n_nationkey AS url, CASE WHEN n_nationkey % 2 = 0 THEN substr(repeat(n_name, 200), 1, 500) ELSE 'N/A' END AS title, 'CVE-2024-' || n_nationkey AS cve FROM nation WHERE n_nationkey % 3 <> 0""")
def build_proofs(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    rows = n.select(F.concat(F.lit("/data/2024/CVE-"), F.when(k % 3 == 0, "2021").otherwise("2024"), F.lit("-"), k.cast("string"), F.lit(".json")).alias("file"), _key(" https://x/", "n_nationkey").alias("html_url"), F.concat("n_name", F.lit("/"), k.cast("string")).alias("full_name"), F.when(k % 2 == 0, F.repeat("n_name", F.lit(200))).alias("description"), F.lit("2024-01-01").alias("created_at"))
    nodes = N.proof_nodes(rows)
    return nodes.join(N.proof_edges(nodes).select(F.col("dst").alias("id")), "id", "left_semi").select("id", "url", "title", "cve")


@query("build_capec", """SELECT 'node' AS kind, 'CAPEC-' || n_nationkey AS src, n_name AS dst FROM nation UNION ALL SELECT 'ChildOf', 'CAPEC-' || n_nationkey, 'CAPEC-' || n_regionkey FROM nation
UNION ALL SELECT 'map', 'CAPEC-' || n_nationkey, 'T1' || lpad(n_nationkey::VARCHAR, 3, '0') FROM nation UNION ALL SELECT 'exploits', 'CAPEC-' || n_nationkey, 'CWE-' || n_regionkey FROM nation""")
def build_capec(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey").cast("string")
    entry = F.concat(F.when(F.col("n_nationkey") % 2 == 0, "T1").otherwise("1"), F.lpad(k, 3, "0"))
    rows = n.select(
        k.alias("_ID"), F.col("n_name").alias("_Name"), F.struct(F.array(F.struct(F.lit("ChildOf").alias("_Nature"), F.col("n_regionkey").cast("string").alias("_CAPEC_ID")), F.struct(F.lit("").alias("_Nature"), F.lit("7").alias("_CAPEC_ID"))).alias("Related_Attack_Pattern")).alias("Related_Attack_Patterns"),
        F.struct(F.array(F.struct(F.col("n_regionkey").cast("string").alias("_CWE_ID"))).alias("Related_Weakness")).alias("Related_Weaknesses"),
        F.struct(F.array(F.struct(F.lit("ATTACK").alias("_Taxonomy_Name"), entry.alias("Entry_ID")), F.struct(F.lit("WASC").alias("_Taxonomy_Name"), F.lit("9").alias("Entry_ID"))).alias("Taxonomy_Mapping")).alias("Taxonomy_Mappings"),
    )
    p = _xml(spark, rows, "Attack_Pattern", N.CAPEC_SCHEMA)
    out = N.capec_nodes(p).where("description = 'N/A'").select(F.lit("node").alias("kind"), F.col("id").alias("src"), F.col("name").alias("dst"))
    return out.union(N.capec_relations(p).select("kind", "src", "dst")).union(N.capec_techniques(p).select(F.lit("map"), "src", "dst")).union(N.capec_weaknesses(p).select(F.lit("exploits"), "src", "dst"))


@query("build_weaknesses", """WITH n AS (SELECT * FROM nation)
SELECT 'weakness' AS kind, 'CWE-' || n_nationkey AS src, n_name AS dst, 'text of it' AS note FROM n UNION ALL SELECT 'method', 'DM-' || n_regionkey, 'method ' || n_regionkey, min(n_nationkey)::VARCHAR FROM n GROUP BY n_regionkey
UNION ALL SELECT 'detects', 'CWE-' || n_nationkey, 'DM-' || n_regionkey, '' FROM n UNION ALL SELECT 'example', 'CVE-2020-' || n_regionkey, min(n_nationkey)::VARCHAR, '' FROM n GROUP BY n_regionkey
UNION ALL SELECT 'observed', 'CWE-' || n_nationkey, 'CVE-2020-' || n_regionkey, n_nationkey::VARCHAR FROM n UNION ALL SELECT 'mitigation', 'CWE-' || n_nationkey, 'CWE-' || n_nationkey || CASE WHEN n_nationkey % 2 = 0 THEN '_MIT-1' ELSE '_MIT_Design_Use' END, '' FROM n
UNION ALL SELECT 'PeerOf', 'CWE-' || n_nationkey, 'CWE-' || n_regionkey, '' FROM n UNION ALL SELECT 'pattern', 'CWE-' || n_nationkey, 'CAPEC-' || n_regionkey, '' FROM n""")
def build_weaknesses(spark, sf):
    n = table(spark, sf, "nation")
    k, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    rows = n.select(
        k.alias("_ID"), F.col("n_name").alias("_Name"), F.lit("text\n  of   it").alias("Description"),
        F.struct(F.array(F.struct(F.lit("PeerOf").alias("_Nature"), r.alias("_CWE_ID")), F.struct(F.lit("StartsWith").alias("_Nature"), F.lit("3").alias("_CWE_ID"))).alias("Related_Weakness")).alias("Related_Weaknesses"),
        F.struct(F.array(F.struct(F.concat(F.lit("DM-"), r).alias("_Detection_Method_ID"), F.concat(F.lit("method "), r).alias("Method"), k.alias("Description"))).alias("Detection_Method")).alias("Detection_Methods"),
        F.struct(F.array(F.struct(F.concat(F.lit("CVE-2020-"), r).alias("Reference"), k.alias("Description"), F.lit("l").alias("Link"))).alias("Observed_Example")).alias("Observed_Examples"),
        F.struct(F.array(F.struct(F.when(F.col("n_nationkey") % 2 == 0, "MIT-1").alias("_Mitigation_ID"), F.array(F.lit("Design"), F.lit("Use")).alias("Phase"), F.lit("d").alias("Description"))).alias("Mitigation")).alias("Potential_Mitigations"),
        F.struct(F.array(F.struct(r.alias("_CAPEC_ID"))).alias("Related_Attack_Pattern")).alias("Related_Attack_Patterns"),
    )
    w = _xml(spark, rows, "Weakness", N.CWE_SCHEMA)
    none = F.lit("").alias("note")
    methods, detects = N.detection_methods(w)
    examples, observed = N.observed_examples(w)
    fixes, fixed = N.mitigations(w)
    out = N.weakness_nodes(w).select(F.lit("weakness").alias("kind"), F.col("id").alias("src"), F.col("name").alias("dst"), F.col("description").alias("note"))
    out = out.union(methods.select(F.lit("method"), "id", "method", "description")).union(detects.select(F.lit("detects"), "src", "dst", none)).union(examples.select(F.lit("example"), "id", "description", none))
    out = out.union(observed.select(F.lit("observed"), "src", "dst", "description")).union(fixed.join(fixes.select(F.col("id").alias("dst")), "dst", "left_semi").select(F.lit("mitigation"), "src", "dst", none))
    return out.union(N.weakness_relations(w).select("kind", "src", "dst", none)).union(N.weakness_patterns(w).select(F.lit("pattern"), "src", "dst", none))


@query("build_defences", """SELECT 'technique' AS kind, 'D3-' || n_nationkey AS src, n_name AS dst FROM nation UNION ALL SELECT 'parent', 'D3-' || n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'D3-T-Harden' ELSE 'D3-' || (n_nationkey - 1) END FROM nation
UNION ALL SELECT 'counters', 'D3-' || n_nationkey, 'T100' || n_regionkey FROM nation UNION ALL SELECT 'tactic', 'D3-T-' || t, CASE t WHEN 'Harden' THEN 'to harden' ELSE t END FROM (SELECT unnest(['Model', 'Harden', 'Detect', 'Isolate', 'Deceive', 'Evict', 'Restore']) AS t)""")
def build_defences(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    up = F.array(F.struct(F.when(k % 2 == 0, "d3f:Harden").otherwise(F.concat(F.lit("d3f:L"), (k - 1).cast("string"))).alias("@id")), F.struct(_key("d3f:L", "n_nationkey").alias("@id")), F.struct(F.lit("owl:Thing").alias("@id")))
    rows = n.select(_key("d3f:L", "n_nationkey").alias("@id"), _key("D3-", "n_nationkey").alias("d3f:d3fend-id"), F.col("n_name").alias("rdfs:label"), up.alias("rdfs:subClassOf"))
    extra = spark.createDataFrame([("d3f:Harden", None, "to harden"), ("d3f:Other", None, "none"), ("owl:x", "D3-X", "no")], "`@id` string, `d3f:d3fend-id` string, `rdfs:label` string")
    ontology = _json(spark, rows.unionByName(extra, allowMissingColumns=True), N.ONTOLOGY_SCHEMA)
    value = lambda c: F.struct(c.alias("value"))
    each = n.select(value(_key("http://d3fend#L", "n_nationkey")).alias("def_tech"), value(_key("T100", "n_regionkey")).alias("off_tech_id"), value(F.col("n_name")).alias("def_tactic_label"))
    bindings = _json(spark, each.union(each), N.BINDING_SCHEMA)
    tactics, techniques = N.defence_nodes(ontology)
    out = techniques.select(F.lit("technique").alias("kind"), F.col("id").alias("src"), F.col("name").alias("dst")).union(N.defence_parents(tactics, techniques).select(F.lit("parent"), "src", "dst"))
    return out.union(N.defence_counters(bindings, techniques).select(F.lit("counters"), "src", "dst")).union(tactics.select(F.lit("tactic"), "id", "name"))


@query("build_engage", """WITH a AS (SELECT 'EAC' || s_suppkey AS id, s_nationkey AS n, s_suppkey AS k FROM supplier)
SELECT 'has_goal' AS kind, id AS src, 'EGO' || (k % 3) AS dst FROM a UNION ALL SELECT 'for_vulnerability', id, 'EAV' || n FROM a UNION ALL SELECT 'with_tactic', id, 'TA' || (k % 4) FROM a UNION ALL SELECT DISTINCT 'maps_ack', 'TA' || (k % 4), 'TA' || (k % 4) FROM a
UNION ALL SELECT DISTINCT 'vulnerability_with_tactic', 'EAV' || n, 'TA' || (k % 4) FROM a UNION ALL SELECT 'for_activity', 'EAP' || k, id FROM a UNION ALL SELECT DISTINCT 'technique_for_vulnerability', 'T' || n, 'EAV' || n FROM a UNION ALL SELECT DISTINCT 'maps_ap', 'T' || n, 'T' || n FROM a
UNION ALL SELECT 'node', 'activity', count(*)::VARCHAR FROM a UNION ALL SELECT 'node', 'vulnerability', count(DISTINCT n)::VARCHAR FROM a""")
def build_engage(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    one = lambda c: F.array(F.struct(c.alias("id")))
    n = F.col("s_nationkey").cast("string")
    acts = _json(spark, s.select(_key("EAC", "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array(F.concat(F.lit("EGO"), (k % 3).cast("string")), F.lit("")).alias("goals"), one(F.concat(F.lit("EAV"), n)).alias("vulnerabilities"), one(F.concat(F.lit("TA"), (k % 4).cast("string"))).alias("attack_tactics")), N.ENGAGE_ACTIVITY)
    approaches = s.select(_key("EAP", "s_suppkey").alias("id"), F.lit("x").alias("name"), F.lit("y").alias("description"), F.array().cast("array<string>").alias("goals"), F.array(_key("EAC", "s_suppkey")).alias("activities"))
    goals = approaches.select("id", "name", "description", F.col("goals").alias("approaches"))
    mapping = s.select(F.concat(F.lit("T"), n).alias("attack_id"), F.concat(F.lit("EAV"), n).alias("eav_id"), _key("EAC", "s_suppkey").alias("eac_id"))
    edges = N.engage_edges(acts, approaches, goals, mapping, approaches.select("id", F.col("goals").alias("tactics")))
    nodes = N.engage_nodes(acts, approaches, goals)
    out = None
    for kind in ("has_goal", "for_vulnerability", "with_tactic", "maps_ack", "vulnerability_with_tactic", "for_activity", "technique_for_vulnerability", "maps_ap"):
        part = edges[kind].select(F.lit(kind).alias("kind"), "src", "dst")
        out = part if out is None else out.union(part)
    for label in ("activity", "vulnerability"):
        out = out.union(nodes[label].agg(F.count("*").cast("string").alias("n")).select(F.lit("node"), F.lit(label), "n"))
    return out


_OBJECTS = "type string, id string, name string, relationship_type string, source_ref string, target_ref string, created string, modified string, description string, x_mitre_deprecated boolean, kill_chain_phases array<struct<kill_chain_name:string,phase_name:string>>"


def _objects(spark, sf):
    """Techniques from suppliers, courses of action from nations, relations between them, and some of unmapped types."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    phases = F.array(F.struct(F.lit("mitre-attack").alias("kill_chain_name"), F.concat(F.lit("phase"), (F.col("s_suppkey") % 5).cast("string")).alias("phase_name")), F.struct(F.lit("other").alias("kill_chain_name"), F.lit("phase0").alias("phase_name")))
    t = s.select(F.lit("attack-pattern").alias("type"), _key("attack-pattern--", "s_suppkey").alias("id"), F.col("s_name").alias("name"), phases.alias("kill_chain_phases"))
    c = n.select(F.lit("course-of-action").alias("type"), _key("course-of-action--", "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    r = s.select(F.lit("relationship").alias("type"), _key("relationship--", "s_suppkey").alias("id"), F.lit("mitigates").alias("relationship_type"), F.when(F.col("s_suppkey") % 6 == 0, "marking--1").otherwise(_key("course-of-action--", "s_nationkey")).alias("source_ref"), _key("attack-pattern--", "s_suppkey").alias("target_ref"), F.lit("2020").alias("created"))
    return _json(spark, t.unionByName(c, allowMissingColumns=True).unionByName(r, allowMissingColumns=True), _OBJECTS)


@query("build_relations", """SELECT 'mitigates' AS kind, 'course-of-action--' || s_nationkey AS src, 'attack-pattern--' || s_suppkey AS dst, 'N/A' AS description FROM supplier WHERE s_suppkey % 6 <> 0 UNION ALL SELECT 'mitigated_by', 'attack-pattern--' || s_suppkey, 'course-of-action--' || s_nationkey, '' FROM supplier WHERE s_suppkey % 6 <> 0
UNION ALL SELECT 'achieves', 'attack-pattern--' || s_suppkey, 'r' || (s_suppkey % 5), '' FROM supplier""")
def build_relations(spark, sf):
    o = _objects(spark, sf)
    rel = N.relationships(o, ["attack-pattern", "course-of-action"])
    tactics = table(spark, sf, "region").select(F.concat(F.lit("phase"), F.col("r_regionkey").cast("string")).alias("shortname"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"))
    none = F.lit("").alias("description")
    return rel.where("created = '2020' and not deprecated").select("kind", "src", "dst", "description").union(N.mitigated_by(rel).select(F.lit("mitigated_by"), "src", "dst", none)).union(N.achieved_tactics(o.where("type = 'attack-pattern'"), tactics).select(F.lit("achieves"), "src", "dst", none))


@query("build_generic_graph", """SELECT 'attack-pattern' AS kind, 'attack-pattern--' || s_suppkey AS src, s_name AS dst FROM supplier UNION ALL SELECT 'course-of-action', 'course-of-action--' || n_nationkey, NULL FROM nation UNION ALL SELECT 'mitigates', 'course-of-action--' || s_nationkey, 'attack-pattern--' || s_suppkey FROM supplier WHERE s_suppkey % 6 <> 0""")
def build_generic_graph(spark, sf):
    nodes, edges = N.generic_graph(_objects(spark, sf), {"attack-pattern": ["name"], "course-of-action": ["description"]})
    return nodes.select(F.col("label").alias("kind"), F.col("id").alias("src"), F.col("properties")["name"].alias("dst")).union(edges.select("kind", "src", "dst"))


@query("build_rule_nodes", "SELECT p_partkey::VARCHAR AS id, p_name AS title, substr(repeat(p_name, 200), 1, 2000) AS description, substr(repeat(p_brand, 100), 1, 500) AS author, 'N/A' AS level FROM part")
def build_rule_nodes(spark, sf):
    p = table(spark, sf, "part")
    return N.rule_nodes(p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), F.repeat("p_name", F.lit(200)).alias("description"), F.repeat("p_brand", F.lit(100)).alias("author"), F.lit(None).cast("string").alias("level")))


@query("choose_scores", """SELECT p_partkey::VARCHAR AS id, CASE p_partkey % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 2.5 END AS score, CASE p_partkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'LOW' END AS severity, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_name END AS vector FROM part""")
def choose_scores(spark, sf):
    """The public database's score, else the issuer's, else none; other versions do not count."""
    p = table(spark, sf, "part")
    m = lambda s, v, x, sev, vec: F.struct(F.lit(s).alias("source"), F.lit(v).alias("version"), F.lit(x).alias("score"), F.lit(sev).alias("severity"), vec.alias("vector"))
    k = F.col("p_partkey") % 3
    metrics = F.array_compact(F.array(F.when(k < 2, m("cna", "3.1", 2.5, "LOW", F.col("p_name"))), m("nvd", "4.0", 9.9, "X", F.col("p_name")), F.when(k == 0, m("nvd", "3.1", 1.5, "HIGH", F.col("p_brand")))))
    rows = p.select(F.col("p_partkey").cast("string").alias("id"), F.array(F.struct(F.lit("es").alias("lang"), F.lit("x").alias("value")), F.struct(F.lit("en").alias("lang"), F.col("p_name").alias("value"))).alias("descriptions"), F.array(F.lit("CWE-1")).alias("weaknesses"), metrics.alias("metrics"))
    return N.chosen_score(rows, "3.1")


@query("score_columns", "SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS description, ['CWE-1'] AS weaknesses, 7.0 AS nvd_v40_score, NULL::DOUBLE AS cna_v31_score FROM part")
def score_columns(spark, sf):
    p = table(spark, sf, "part")
    d = lambda lang, v: F.struct(F.lit(lang).alias("lang"), v.alias("value"))
    texts = F.when(F.col("p_partkey") % 2 == 0, F.array(d("es", F.col("p_type")), d("en", F.col("p_name")))).otherwise(F.array(d("fr", F.col("p_brand"))))
    rows = p.select(F.col("p_partkey").cast("string").alias("id"), texts.alias("descriptions"), F.array(F.lit("CWE-1"), F.lit(""), F.lit("CWE-1")).alias("weaknesses"), F.array(F.struct(F.lit("nvd").alias("source"), F.lit("4.0").alias("version"), F.lit(7.0).alias("score"), F.lit("H").alias("severity"), F.lit("v").alias("vector"))).alias("metrics"))
    return N.score_columns(rows).select("id", "description", "weaknesses", "nvd_v40_score", "cna_v31_score")


_STIX = _OBJECTS + ", external_references array<struct<source_name:string,external_id:string>>, x_mitre_platforms array<string>, x_mitre_is_subtechnique boolean, aliases array<string>, first_seen string, x_mitre_log_source_references array<struct<x_mitre_data_component_ref:string>>, x_mitre_analytic_refs array<string>"


def _stix(spark, sf):
    """Techniques from suppliers, groups from nations, analytics from customers, components from regions, a strategy for each nation."""
    s, n, c, r = (table(spark, sf, x) for x in ("supplier", "nation", "customer", "region"))
    refs = lambda k: F.array(F.struct(F.lit("other").alias("source_name"), F.lit("x").alias("external_id")), F.struct(F.lit("mitre-attack").alias("source_name"), k.alias("external_id")))
    text = lambda c: F.col(c).cast("string")
    parts = [
        s.select(F.lit("attack-pattern").alias("type"), _key("attack-pattern--", "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, refs(_key("T", "s_suppkey"))).alias("external_references"), F.lit("2020-01-02").alias("created"), F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("Linux"), F.lit("Windows"))).alias("x_mitre_platforms"), (F.col("s_suppkey") % 5 == 0).alias("x_mitre_is_subtechnique")),
        n.select(F.lit("intrusion-set").alias("type"), _key("intrusion-set--", "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.array("n_name", F.lower("n_name")).alias("aliases"), F.lit("2021-03-04 05 : 06:07").alias("modified")),
        r.select(F.lit("x-mitre-data-component").alias("type"), _key("x-mitre-data-component--", "r_regionkey").alias("id"), F.col("r_name").alias("name")),
        c.select(F.lit("x-mitre-analytic").alias("type"), _key("x-mitre-analytic--", "c_custkey").alias("id"), F.array(*[F.struct(F.concat(F.lit("x-mitre-data-component--"), ((F.col("c_nationkey") + i) % 7).cast("string")).alias("x_mitre_data_component_ref")) for i in (0, 1, 0)]).alias("x_mitre_log_source_references")),
        c.groupBy("c_nationkey").agg(F.collect_list(_key("x-mitre-analytic--", "c_custkey")).alias("a")).select(F.lit("x-mitre-detection-strategy").alias("type"), _key("x-mitre-detection-strategy--", "c_nationkey").alias("id"), F.concat("a", F.array(F.lit("x-mitre-analytic--none"))).alias("x_mitre_analytic_refs")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return _json(spark, out, _STIX)


@query("build_objects", """SELECT 'attack-pattern' AS type, 'attack-pattern--' || s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'T' || s_suppkey ELSE 'N/A' END AS mitre_id, '2020-01-02T00:00:00' AS created, 'N/A' AS modified, CASE WHEN s_suppkey % 2 = 0 THEN '[{"source_name": "other", "external_id": "x"}, {"source_name": "mitre-attack", "external_id": "T' || s_suppkey || '"}]' ELSE '[]' END AS refs, CASE WHEN s_suppkey % 3 = 0 THEN 'Linux,Windows' ELSE '' END AS listed, s_suppkey % 5 = 0 AS flag FROM supplier
UNION ALL SELECT 'intrusion-set', 'intrusion-set--' || n_nationkey, n_name, 'N/A', 'N/A', '2021-03-04T05:06:07', '[]', n_name || ',' || lower(n_name), false FROM nation UNION ALL SELECT 'x-mitre-data-component', 'x-mitre-data-component--' || r_regionkey, r_name, 'N/A', 'N/A', 'N/A', NULL, NULL, false FROM region""")
def build_objects(spark, sf):
    """Nodes of three of the eleven types, each with what it has of the common and its own properties."""
    from kilnspark.operators import stix as X

    o = _stix(spark, sf)
    common = ["type", "id", "name", "mitre_id", "created", "modified"]
    t = X.object_nodes(o, "attack-pattern").select(*common, F.col("external_references").alias("refs"), F.array_join("x_mitre_platforms", ",").alias("listed"), F.col("x_mitre_is_subtechnique").alias("flag"))
    g = X.object_nodes(o, "intrusion-set").select(*common, F.col("external_references").alias("refs"), F.array_join("aliases", ",").alias("listed"), F.col("revoked").alias("flag"))
    d = X.object_nodes(o, "x-mitre-data-component").select(*common, F.lit(None).cast("string").alias("refs"), F.lit(None).cast("string").alias("listed"), F.col("revoked").alias("flag"))
    return t.unionByName(g).unionByName(d)


@query("build_derived_edges", """SELECT DISTINCT 'requires_data' AS kind, 'x-mitre-analytic--' || c_custkey AS src, 'x-mitre-data-component--' || ((c_nationkey + i) % 7) AS dst FROM customer, (SELECT unnest([0, 1]) AS i) WHERE (c_nationkey + i) % 7 IN (SELECT r_regionkey FROM region)
UNION ALL SELECT 'implemented_by', 'x-mitre-detection-strategy--' || c_nationkey, 'x-mitre-analytic--' || c_custkey FROM customer""")
def build_derived_edges(spark, sf):
    """References that objects list, as edges; those that lead nowhere are none."""
    from kilnspark.operators import stix as X

    edges = X.derived_edges(_stix(spark, sf))
    return edges["requires_data"].select(F.lit("requires_data").alias("kind"), "src", "dst").union(edges["implemented_by"].select(F.lit("implemented_by"), "src", "dst"))


@query("build_configured_graph", """SELECT 'node' AS part, 'order' AS name, count(*) AS n FROM orders UNION ALL SELECT 'node', 'customer', count(*) FROM customer UNION ALL SELECT 'edge', 'placed', count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'edge', 'near', count(*) FROM (SELECT o_orderkey, unnest([o_custkey, o_custkey + 1]) AS k FROM orders) JOIN customer ON c_custkey = k
UNION ALL SELECT 'public', 'O-', count(*) FROM orders WHERE o_orderkey % 3 = 0""")
def build_configured_graph(spark, sf):
    """A document for each order and each customer; relations listed, links made of properties, both counted once they are written."""
    from kilnspark.operators import stix as X
    from kilnspark.sources.workspace import folder

    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    text = lambda k: F.col(k).cast("string")
    thing = lambda **x: F.struct(*[x.get(k, F.lit(None).cast("string")).alias(k) for k in ("uid", "kind", "tags", "key", "ext", "rel", "a", "b") if k != "tags" and k != "ext"], x.get("tags", F.lit(None).cast("array<string>")).alias("tags"), x.get("ext", F.lit(None).cast("array<struct<who:string,id:string>>")).alias("ext"))
    order = thing(uid=F.concat(F.lit("o"), text("o_orderkey")), kind=F.lit("order"), tags=F.array(text("o_custkey"), (F.col("o_custkey") + 1).cast("string")), ext=F.when(F.col("o_orderkey") % 3 == 0, F.array(F.struct(F.lit("x").alias("who"), F.concat(F.lit("O-"), text("o_orderkey")).alias("id")))))
    placed = thing(uid=F.concat(F.lit("r"), text("o_orderkey")), kind=F.lit("link"), rel=F.lit("placed"), a=F.concat(F.lit("c"), text("o_custkey")), b=F.concat(F.lit("o"), text("o_orderkey")))
    note = thing(uid=F.concat(F.lit("n"), text("o_orderkey")), kind=F.lit("note"))
    docs = o.select(F.struct(F.when(F.col("o_orderkey") % 2 == 0, F.array(order, placed, note)).otherwise(F.array(order)).alias("all")).alias("body"))
    docs = docs.unionByName(c.select(F.struct(F.array(thing(uid=F.concat(F.lit("c"), text("c_custkey")), kind=F.lit("customer"), key=text("c_custkey"))).alias("all")).alias("body")))
    config = X.GraphConfig("body/all/*", "uid", "kind", "ext/?/id", "link", "rel", "a", "b", ("note",), (X.Link("near", "order", "tags/*", "customer", "key"),))
    nodes, edges = X.configured_graph(docs, config)
    counts = X.create_graph(folder(spark), nodes, edges)
    public = nodes.where(F.col("public_id").startswith("O-")).agg(F.count("*").alias("n")).select(F.lit("public").alias("part"), F.lit("O-").alias("name"), "n")
    return counts.unionByName(public)
