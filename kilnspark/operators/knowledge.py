"""Nodes and edges of a security knowledge graph from its public source formats.

Each function takes rows as the readers give them (schemas below) and returns
nodes (``id`` and properties) or edges (``src``, ``dst`` and properties).
Edges are by identifier; ``Graph.add_edges`` keeps those whose ends exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.operators.build import year_from

FIRST_YEAR = 2024
TEXTS = "array<string>"

_PROBLEM = "struct<descriptions:array<struct<cweId:string,description:string>>>"
CVE_SCHEMA = (
    "cveMetadata struct<cveId:string,datePublished:string,dateUpdated:string>, containers struct<cna:struct<title:string,descriptions:array<struct<value:string>>,"
    "affected:array<struct<vendor:string,product:string>>,metrics:array<struct<cvssV3_1:struct<attackVector:string,baseScore:double,vectorString:string>>>,"
    f"workarounds:array<struct<description:string>>,exploits:array<struct<description:string>>,impacts:array<struct<capecId:string>>,problemTypes:array<{_PROBLEM}>>>"
)
_CPE = "criteria:string,vulnerable:boolean,versionStartIncluding:string,versionStartExcluding:string,versionEndIncluding:string,versionEndExcluding:string"
NVD_SCHEMA = f"cve struct<id:string,configurations:array<struct<nodes:array<struct<cpeMatch:array<struct<{_CPE}>>>>>>>"
KEV_SCHEMA = "cveID string, vendorProject string, product string, vulnerabilityName string, dateAdded string, shortDescription string, requiredAction string, dueDate string, knownRansomwareCampaignUse string, notes string, cwes array<string>"
CAPEC_SCHEMA = (
    "_ID string, _Name string, Description string, Likelihood_Of_Attack string, Typical_Severity string, Related_Attack_Patterns struct<Related_Attack_Pattern:array<struct<_Nature:string,_CAPEC_ID:string>>>,"
    "Prerequisites struct<Prerequisite:array<string>>, Related_Weaknesses struct<Related_Weakness:array<struct<_CWE_ID:string>>>, Taxonomy_Mappings struct<Taxonomy_Mapping:array<struct<_Taxonomy_Name:string,Entry_ID:string,Entry_Name:string>>>"
)
CWE_SCHEMA = (
    "_ID string, _Name string, _Abstraction string, Description string, Extended_Description string, Likelihood_Of_Exploit string,"
    "Modes_Of_Introduction struct<Introduction:array<struct<Phase:string,Note:string>>>, Related_Weaknesses struct<Related_Weakness:array<struct<_Nature:string,_CWE_ID:string>>>,"
    "Detection_Methods struct<Detection_Method:array<struct<_Detection_Method_ID:string,Method:string,Description:string,Effectiveness:string>>>,"
    "Observed_Examples struct<Observed_Example:array<struct<Reference:string,Description:string,Link:string>>>,"
    "Potential_Mitigations struct<Mitigation:array<struct<_Mitigation_ID:string,Phase:array<string>,Description:string,Effectiveness:string,Strategy:string>>>,"
    "Related_Attack_Patterns struct<Related_Attack_Pattern:array<struct<_CAPEC_ID:string>>>"
)


def _or_na(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("N/A"))


def _flat(text: Column) -> Column:
    """White space squashed; nothing is N/A."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.coalesce(flat, F.lit("")) == "", "N/A").otherwise(flat)


def _filled(items: Column) -> Column:
    """The items with text, an empty array for none."""
    return F.filter(F.coalesce(items, F.array().cast(TEXTS)), lambda x: F.coalesce(x, F.lit("")) != "")


def _prefixed(ids: Column, prefix: str) -> Column:
    return F.when(ids.startswith(prefix), ids).otherwise(F.concat(F.lit(prefix), ids))


# ---------------------------------------------------------------- vulnerabilities


def cpe_index(nvd: DataFrame) -> DataFrame:
    """``(id, matches)``: product matches with a criterion, in their six keys."""
    nodes = F.flatten(F.transform(F.col("cve.configurations"), lambda c: F.coalesce(c["nodes"], F.array().cast(f"array<struct<cpeMatch:array<struct<{_CPE}>>>>"))))
    matches = F.flatten(F.transform(nodes, lambda n: F.coalesce(n["cpeMatch"], F.array().cast(f"array<struct<{_CPE}>>"))))
    rows = nvd.select(F.col("cve.id").alias("id"), F.filter(matches, lambda m: m["criteria"].isNotNull()).alias("matches"))
    return rows.where("id is not null and size(matches) > 0").groupBy("id").agg(F.max_by("matches", F.to_json("matches")).alias("matches"))


def cve_fields(records: DataFrame) -> DataFrame:
    """Projection of CVE records: title, texts, products, first score, workarounds, exploits and the raw relation lists."""
    cna = F.col("containers.cna")
    score = F.get(cna["metrics"], F.lit(0))["cvssV3_1"]
    return records.where(F.col("cveMetadata.cveId").isNotNull()).select(
        F.col("cveMetadata.cveId").alias("id"), F.col("cveMetadata.datePublished").alias("created"), F.col("cveMetadata.dateUpdated").alias("modified"), _or_na(cna["title"]).alias("title"),
        _filled(F.transform(cna["descriptions"], lambda d: d["value"])).alias("descriptions"), _filled(F.transform(cna["affected"], lambda a: a["product"])).alias("affected_products"),
        _or_na(score["attackVector"]).alias("attack_vector"), score["baseScore"].alias("base_score"), score["vectorString"].alias("vector"),
        _filled(F.transform(cna["workarounds"], lambda w: w["description"])).alias("workarounds"), _filled(F.transform(cna["exploits"], lambda e: e["description"])).alias("exploits"),
        F.transform(cna["impacts"], lambda i: F.trim(i["capecId"])).alias("impacts"), F.flatten(F.transform(cna["problemTypes"], lambda p: p["descriptions"])).alias("problems"),
    )


def cve_nodes(records: DataFrame, index: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """CVE nodes of the year on, with their product matches as JSON."""
    rows = cve_fields(records).where(year_from(F.col("id"), first_year)).drop("impacts", "problems")
    return rows.join(index, "id", "left").withColumn("cpe_matches", F.coalesce(F.to_json("matches"), F.lit("[]"))).drop("matches")


def cve_impacts(records: DataFrame) -> DataFrame:
    """CVE to attack pattern; ids get their prefix."""
    rows = cve_fields(records).select(F.col("id").alias("src"), F.explode("impacts").alias("x")).where("x <> ''")
    return rows.select("src", _prefixed(F.col("x"), "CAPEC-").alias("dst")).distinct()


def cve_problems(records: DataFrame) -> DataFrame:
    """CVE to weakness."""
    return _problems(records).select(F.col("id").alias("src"), F.col("cwe").alias("dst")).distinct()


def _problems(records: DataFrame) -> DataFrame:
    rows = cve_fields(records).select("id", F.posexplode("problems").alias("n", "p"))
    return rows.select("id", "n", F.col("p.cweId").alias("cwe"), F.substring(_or_na(F.col("p.description")), 1, 200).alias("description")).where("coalesce(cwe, '') <> ''")


def weakness_observed(records: DataFrame) -> DataFrame:
    """Weakness to CVE with a description of 200 characters; of several the last one stays."""
    return _problems(records).groupBy(F.col("cwe").alias("src"), F.col("id").alias("dst")).agg(F.max_by("description", "n").alias("description"))


def kev_nodes(rows: DataFrame) -> DataFrame:
    """Known exploited vulnerabilities; missing texts become N/A."""
    texts = ["vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription", "requiredAction", "dueDate", "knownRansomwareCampaignUse", "notes"]
    return rows.where("coalesce(cveID, '') <> ''").select(F.col("cveID").alias("id"), *[_or_na(c).alias(c) for c in texts], F.transform(_filled(F.col("cwes")), lambda x: F.trim(x)).alias("cwes"))


def kev_edges(rows: DataFrame) -> dict[str, DataFrame]:
    """for_CVE, known_exploit from the CVE and known_exploit from each weakness."""
    kev = kev_nodes(rows)
    own = kev.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    weak = kev.select(F.explode("cwes").alias("src"), F.col("id").alias("dst")).where("src <> ''").distinct()
    return {"for_CVE": own, "cve_known_exploit": own, "weakness_known_exploit": weak}


def epss_nodes(rows: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Scores of CVEs of the year on; the edge ``scores`` has the same id at both ends."""
    number = lambda c: F.try_to_number(F.trim(c), F.lit("9.999999999")).cast("double")
    cve = F.trim("cve")
    return rows.where((F.coalesce(cve, F.lit("")) != "") & year_from(cve, first_year)).select(cve.alias("id"), number("epss").alias("epss"), number("percentile").alias("percentile"))


def proof_nodes(repositories: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Proof-of-concept repositories of (file, html_url, full_name, description, created_at): the file's name is the CVE."""
    cve = F.regexp_extract("file", r"([^/]*)\.json$", 1)
    url = F.trim("html_url")
    rows = repositories.select(cve.alias("cve"), url.alias("url"), F.trim(F.coalesce("full_name", "html_url")).alias("name"), "description", F.trim("created_at").alias("published"))
    good = rows.where((F.coalesce(F.col("url"), F.lit("")) != "") & F.col("cve").startswith("CVE-") & year_from(F.col("cve"), first_year))
    title = F.when(F.coalesce("description", F.lit("")) == "", "N/A").otherwise(F.substring("description", 1, 500))
    return good.select(F.concat(F.lit("POC-"), F.replace(F.col("name"), F.lit("/"), F.lit("-"))).alias("id"), "url", title.alias("title"), "published", "cve")


def proof_edges(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("cve").alias("src"), F.col("id").alias("dst")).distinct()


# ---------------------------------------------------------------- attack patterns and weaknesses


def capec_nodes(patterns: DataFrame) -> DataFrame:
    """Attack patterns; nested parts become JSON texts."""
    return patterns.where("_ID is not null").select(
        F.concat(F.lit("CAPEC-"), "_ID").alias("id"), _or_na("_Name").alias("name"), _flat(F.col("Description")).alias("description"), _flat(F.col("Likelihood_Of_Attack")).alias("likelihood"),
        _flat(F.col("Typical_Severity")).alias("severity"), F.coalesce(F.to_json(F.transform(F.col("Prerequisites.Prerequisite"), _flat)), F.lit("[]")).alias("prerequisites"),
    )


def capec_relations(patterns: DataFrame) -> DataFrame:
    """Pattern to pattern; the edge's kind is the nature of the relation."""
    rows = patterns.where("_ID is not null").select("_ID", F.explode("Related_Attack_Patterns.Related_Attack_Pattern").alias("r"))
    kind = F.trim("r._Nature")
    return rows.where((F.coalesce(kind, F.lit("")) != "") & F.col("r._CAPEC_ID").isNotNull()).select(F.concat(F.lit("CAPEC-"), "_ID").alias("src"), F.concat(F.lit("CAPEC-"), "r._CAPEC_ID").alias("dst"), kind.alias("kind")).distinct()


def capec_techniques(patterns: DataFrame) -> DataFrame:
    """Pattern to technique by taxonomy mappings that speak of ATT&CK; ids get their T."""
    rows = patterns.where("_ID is not null").select("_ID", F.explode("Taxonomy_Mappings.Taxonomy_Mapping").alias("t"))
    entry = F.trim("t.Entry_ID")
    mapped = F.upper("t._Taxonomy_Name").rlike("ATT&CK|ATTACK") & (F.coalesce(entry, F.lit("")) != "")
    return rows.where(mapped).select(F.concat(F.lit("CAPEC-"), "_ID").alias("src"), _prefixed(entry, "T").alias("dst")).distinct()


def capec_weaknesses(patterns: DataFrame) -> DataFrame:
    """Pattern exploits weakness."""
    rows = patterns.where("_ID is not null").select("_ID", F.explode("Related_Weaknesses.Related_Weakness._CWE_ID").alias("w")).where("coalesce(w, '') <> ''")
    return rows.select(F.concat(F.lit("CAPEC-"), "_ID").alias("src"), F.concat(F.lit("CWE-"), "w").alias("dst")).distinct()


def weakness_nodes(rows: DataFrame) -> DataFrame:
    intros = F.coalesce(F.col("Modes_Of_Introduction.Introduction"), F.array().cast("array<struct<Phase:string,Note:string>>"))
    return _weak(rows).select(
        "id", _or_na("_Name").alias("name"), _or_na("_Abstraction").alias("abstraction"), _flat(F.col("Description")).alias("description"), _flat(F.col("Extended_Description")).alias("extended_description"),
        _flat(F.col("Likelihood_Of_Exploit")).alias("likelihood_of_exploit"), _filled(F.transform(intros, lambda i: F.trim(i["Phase"]))).alias("phases"),
    )


def _weak(rows: DataFrame) -> DataFrame:
    return rows.where("_ID is not null").withColumn("id", F.concat(F.lit("CWE-"), "_ID"))


def detection_methods(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Methods once each, the first weakness in id order gives the texts; edges weakness to method."""
    each = _weak(rows).select("id", F.posexplode("Detection_Methods.Detection_Method").alias("n", "d"))
    method = _flat(F.col("d.Method"))
    given = F.trim(F.coalesce("d._Detection_Method_ID", F.lit("")))
    each = each.select("id", "n", F.when(given == "", F.concat(F.lit("DM_"), method)).otherwise(given).alias("key"), method.alias("method"), _flat(F.col("d.Description")).alias("description"), _flat(F.col("d.Effectiveness")).alias("effectiveness"))
    first = each.groupBy("key").agg(F.min_by(F.struct("method", "description", "effectiveness"), F.struct(F.substring("id", 5, 20).cast("int"), "n")).alias("x"))
    return first.select(F.col("key").alias("id"), "x.*"), each.select(F.col("id").alias("src"), F.col("key").alias("dst")).distinct()


def observed_examples(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Examples once each by their reference; edges weakness to CVE with description and link."""
    each = _weak(rows).select("id", F.posexplode("Observed_Examples.Observed_Example").alias("n", "o"))
    each = each.select("id", "n", _flat(F.col("o.Reference")).alias("reference"), _flat(F.col("o.Description")).alias("description"), _flat(F.col("o.Link")).alias("link")).where("reference <> 'N/A'")
    first = each.groupBy("reference").agg(F.min_by(F.struct("description", "link"), F.struct(F.substring("id", 5, 20).cast("int"), "n")).alias("x"))
    last = each.groupBy(F.col("id").alias("src"), F.col("reference").alias("dst")).agg(F.max_by(F.struct("description", "link"), "n").alias("x"))
    return first.select(F.col("reference").alias("id"), "x.*"), last.select("src", "dst", "x.*")


def mitigations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mitigations under their weakness (``CWE-1_MIT-2``; without an id by their phases); edges weakness to mitigation."""
    each = _weak(rows).select("id", F.explode("Potential_Mitigations.Mitigation").alias("m"))
    phases = F.transform(_filled(F.col("m.Phase")), lambda x: F.trim(x))
    own = F.when(F.coalesce("m._Mitigation_ID", F.lit("")) == "", F.concat(F.lit("MIT_"), F.array_join(phases, "_"))).otherwise(F.col("m._Mitigation_ID"))
    nodes = each.select(F.concat("id", F.lit("_"), own).alias("key"), F.col("id").alias("src"), phases.alias("phase"), _flat(F.col("m.Description")).alias("description"), _flat(F.col("m.Effectiveness")).alias("effectiveness"), _flat(F.col("m.Strategy")).alias("strategy"))
    return nodes.select(F.col("key").alias("id"), "phase", "description", "effectiveness", "strategy"), nodes.select("src", F.col("key").alias("dst")).distinct()


#: Relations between weaknesses that become edges.
WEAKNESS_KINDS = ("ChildOf", "CanPrecede", "PeerOf")


def weakness_relations(rows: DataFrame) -> DataFrame:
    each = _weak(rows).select(F.col("id").alias("src"), F.explode("Related_Weaknesses.Related_Weakness").alias("r"))
    return each.where(F.col("r._Nature").isin(*WEAKNESS_KINDS)).select("src", F.concat(F.lit("CWE-"), "r._CWE_ID").alias("dst"), F.col("r._Nature").alias("kind")).distinct()


def weakness_patterns(rows: DataFrame) -> DataFrame:
    each = _weak(rows).select(F.col("id").alias("src"), F.explode("Related_Attack_Patterns.Related_Attack_Pattern._CAPEC_ID").alias("c")).where("coalesce(c, '') <> ''")
    return each.select("src", F.concat(F.lit("CAPEC-"), "c").alias("dst")).distinct()


# ---------------------------------------------------------------- defences

#: Defensive tactics, which exist whether the ontology holds them or not.
DEFENCE_TACTICS = ("Model", "Harden", "Detect", "Isolate", "Deceive", "Evict", "Restore")
ONTOLOGY_SCHEMA = "`@id` string, `d3f:d3fend-id` string, `rdfs:label` string, `d3f:definition` string, `d3f:synonym` array<string>, `rdfs:subClassOf` array<struct<`@id`:string>>"
BINDING_SCHEMA = ", ".join(f"{c} struct<value:string>" for c in ("def_tech", "off_tech_id", "def_tactic_label", "def_artifact_label", "def_artifact_rel_label", "off_artifact_label", "off_artifact_rel_label"))


def _local(c: Column) -> Column:
    return F.when(c.startswith("d3f:"), F.substring_index(c, ":", -1))


def defence_nodes(ontology: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tactics (synthesised, texts from the ontology where it has them) and techniques with an id and a label."""
    e = ontology.select(_local(F.col("`@id`")).alias("local"), F.col("`d3f:d3fend-id`").alias("id"), F.col("`rdfs:label`").alias("label"), F.substring(F.coalesce("`d3f:definition`", F.lit("")), 1, 2000).alias("definition"), F.coalesce("`d3f:synonym`", F.array().cast(TEXTS)).alias("synonyms"), F.col("`rdfs:subClassOf`").alias("up")).where("local is not null")
    names = ontology.sparkSession.createDataFrame([(t,) for t in DEFENCE_TACTICS], "local string")
    tactics = names.join(e.select("local", "label", "definition"), "local", "left")
    tactics = tactics.select(F.concat(F.lit("D3-T-"), "local").alias("id"), F.substring(F.coalesce("label", "local"), 1, 200).alias("name"), "local", F.coalesce("definition", F.lit("")).alias("definition"))
    techniques = e.where("coalesce(id, '') <> '' and coalesce(label, '') <> ''")
    return tactics, techniques.select("id", F.substring("label", 1, 300).alias("name"), "local", "definition", "synonyms", F.transform("up", lambda p: _local(p["@id"])).alias("parents"))


def defence_parents(tactics: DataFrame, techniques: DataFrame) -> DataFrame:
    """Technique to parent technique or tactic, never to itself; a technique wins over a tactic of the same name."""
    ends = tactics.select("local", F.col("id").alias("dst"), F.lit(1).alias("rank")).union(techniques.select("local", "id", F.lit(0)))
    ends = ends.groupBy("local").agg(F.min_by("dst", "rank").alias("dst"))
    return techniques.select(F.col("id").alias("src"), F.explode("parents").alias("local")).join(ends, "local").where("src <> dst").select("src", "dst").distinct()


def defence_counters(bindings: DataFrame, techniques: DataFrame) -> DataFrame:
    """Technique counters attack technique, once each: the first binding in order of its texts stays."""
    labels = ("def_tactic", "def_artifact", "def_artifact_rel", "off_artifact", "off_artifact_rel")
    text = lambda c: F.coalesce(F.col(f"{c}.value"), F.lit(""))
    rows = bindings.select(F.substring_index(text("def_tech"), "#", -1).alias("local"), text("off_tech_id").alias("dst"), F.struct(*[text(f"{c}_label").alias(c) for c in labels]).alias("x")).where("local <> '' and dst <> ''")
    found = rows.join(techniques.select("local", F.col("id").alias("src")), "local")
    return found.groupBy("src", "dst").agg(F.min("x").alias("x")).select("src", "dst", "x.*")


# ---------------------------------------------------------------- engagement

ENGAGE_ACTIVITY = "id string, name string, description string, goals array<string>, approaches array<string>, vulnerabilities array<struct<id:string>>, attack_techniques array<struct<id:string>>, attack_tactics array<struct<id:string>>, references array<struct<id:string>>"
#: Labels of the engagement graph.
ENGAGE_LABELS = ("activity", "approach", "goal", "vulnerability", "attack_technique", "attack_tactic", "reference")


def engage_nodes(activities: DataFrame, approaches: DataFrame, goals: DataFrame) -> dict[str, DataFrame]:
    """Seven labels: three from their own files, the others as they are named by activities."""
    named = lambda rows: rows.where("coalesce(id, '') <> ''").select("id", _or_na("name").alias("name"), _or_na("description").alias("description")).dropDuplicates(["id"])
    out = {"activity": named(activities), "approach": named(approaches), "goal": named(goals)}
    for label, column in (("vulnerability", "vulnerabilities"), ("attack_technique", "attack_techniques"), ("attack_tactic", "attack_tactics"), ("reference", "references")):
        out[label] = activities.select(F.explode(f"{column}.id").alias("id")).where("coalesce(id, '') <> ''").distinct()
    return out


def engage_edges(activities: DataFrame, approaches: DataFrame, goals: DataFrame, mapping: DataFrame, tactics: DataFrame) -> dict[str, DataFrame]:
    """The edge kinds between engagement labels and to attack techniques and tactics.

    ``approaches`` has goals and activities, ``goals`` has approaches, ``mapping``
    has (attack_id, eav_id, eac_id) and ``tactics`` has (id, tactics).
    """

    def of(rows: DataFrame, column: str, inner: str | None = None) -> DataFrame:
        ends = rows.select(F.col("id").alias("src"), F.explode(f"{column}.{inner}" if inner else column).alias("dst"))
        return ends.where("coalesce(src, '') <> '' and coalesce(dst, '') <> ''").distinct()

    pair = lambda rows, a, b: rows.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("coalesce(src, '') <> '' and coalesce(dst, '') <> ''").distinct()
    used = activities.select(F.explode("attack_tactics.id").alias("tac"), F.col("vulnerabilities.id").alias("vs")).where("coalesce(tac, '') <> ''")
    same = lambda rows: rows.select(F.col("src"), F.col("src").alias("dst")).distinct()
    with_tactic = of(activities, "attack_tactics", "id")
    return {
        "has_goal": of(activities, "goals"), "has_approach": of(activities, "approaches"), "for_vulnerability": of(activities, "vulnerabilities", "id"), "uses_technique": of(activities, "attack_techniques", "id"),
        "with_tactic": with_tactic, "maps_ack": same(with_tactic.select(F.col("dst").alias("src"))), "vulnerability_with_tactic": used.select(F.explode("vs").alias("src"), F.col("tac").alias("dst")).where("coalesce(src, '') <> ''").distinct(),
        "has_reference": of(activities, "references", "id"), "with_goal": of(approaches, "goals"), "for_activity": of(approaches, "activities"), "for_approach": of(goals, "approaches"),
        "maps_ap": same(pair(mapping, "attack_id", "attack_id")), "technique_for_vulnerability": pair(mapping, "attack_id", "eav_id"), "technique_for_activity": pair(mapping, "attack_id", "eac_id"), "achieves": of(tactics, "tactics"),
    }


# ---------------------------------------------------------------- attack objects


def relationships(objects: DataFrame, labels: list[str]) -> DataFrame:
    """Relations whose both types are mapped: (kind, src_label, dst_label, src, dst, created, modified, description, deprecated)."""
    label = lambda c: F.substring_index(c, "--", 1)
    rows = objects.where("type = 'relationship'").select(
        F.col("relationship_type").alias("kind"), label("source_ref").alias("src_label"), label("target_ref").alias("dst_label"), F.col("source_ref").alias("src"), F.col("target_ref").alias("dst"),
        "created", "modified", _or_na("description").alias("description"), F.coalesce("x_mitre_deprecated", F.lit(False)).alias("deprecated"),
    )
    return rows.where(F.col("src_label").isin(*labels) & F.col("dst_label").isin(*labels))


def achieved_tactics(techniques: DataFrame, tactics: DataFrame, chain: str = "mitre-attack") -> DataFrame:
    """Technique to tactic by the phases of one kill chain."""
    phases = techniques.select(F.col("id").alias("src"), F.explode("kill_chain_phases").alias("p")).where(F.col("p.kill_chain_name") == chain).select("src", F.col("p.phase_name").alias("shortname"))
    return phases.join(tactics.select("shortname", F.col("id").alias("dst")), "shortname").select("src", "dst").distinct()


def mitigated_by(relations: DataFrame) -> DataFrame:
    """Inverse of mitigates between courses of action and techniques."""
    return relations.where("kind = 'mitigates' and src_label = 'course-of-action' and dst_label = 'attack-pattern'").select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()


def listed_references(objects: DataFrame, column: str) -> DataFrame:
    """Edges from an object to the ids it lists."""
    return objects.select(F.col("id").alias("src"), F.explode(column).alias("dst")).distinct()


def rule_nodes(rules: DataFrame) -> DataFrame:
    """Detection rules: long descriptions and authors are cut."""
    return rules.where("id is not null").select("id", _or_na("title").alias("title"), F.substring(_or_na("description"), 1, 2000).alias("description"), F.substring(_or_na("author"), 1, 500).alias("author"), _or_na("level").alias("level"))


def _of(metrics: str, source: str, version: str) -> Column:
    return F.filter(metrics, lambda m: (m["source"] == source) & (m["version"] == version))


def score_columns(records: DataFrame) -> DataFrame:
    """API records flattened: English description (else the first), weakness list, and score columns of both sources and versions.

    ``records`` has id, descriptions (lang, value), weaknesses and metrics (source, version, score, severity, vector).
    """
    english = F.filter("descriptions", lambda d: d["lang"] == "en")
    text = F.coalesce(F.get(english, F.lit(0))["value"], F.get("descriptions", F.lit(0))["value"])
    out = [F.col("id"), text.alias("description"), F.array_distinct(_filled(F.col("weaknesses"))).alias("weaknesses")]
    for source in ("nvd", "cna"):
        for version in ("3.1", "4.0"):
            first = F.get(_of("metrics", source, version), F.lit(0))
            out += [first[c].alias(f"{source}_v{version.replace('.', '')}_{c}") for c in ("score", "severity", "vector")]
    return records.select(*out)


def chosen_score(records: DataFrame, version: str, nvd_only: bool = False) -> DataFrame:
    """The score of one version, from the public database first and from the issuer only if that is allowed."""
    v = version.replace(".", "")
    take = lambda c: F.col(f"nvd_v{v}_{c}") if nvd_only else F.when(F.col(f"nvd_v{v}_score").isNotNull(), F.col(f"nvd_v{v}_{c}")).otherwise(F.col(f"cna_v{v}_{c}"))
    return score_columns(records).select("id", *[take(c).alias(c) for c in ("score", "severity", "vector")])


def generic_graph(objects: DataFrame, labels: dict[str, list[str]], relation: str = "relationship") -> tuple[DataFrame, DataFrame]:
    """Nodes (label, id, properties) and edges (kind, src, dst) of any STIX-like objects; ``labels`` names the properties of each type."""
    parts = []
    for label, properties in labels.items():
        pairs = [x for p in properties for x in (F.lit(p), F.col(p).cast("string"))]
        filled = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
        parts.append(objects.where(F.col("type") == label).select(F.lit(label).alias("label"), "id", filled.alias("properties")))
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.union(p)
    edges = objects.where(F.col("type") == relation).select(F.col("relationship_type").alias("kind"), F.col("source_ref").alias("src"), F.col("target_ref").alias("dst"))
    ids = nodes.select("id")
    return nodes, edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select("kind", "src", "dst").distinct()
