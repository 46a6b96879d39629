"""Knowledge records as text: projections over declared structs, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.functions.nested import is_json, json_items, json_object, json_pairs, json_string, json_text, map_strings

#: Object types that give documents.
STIX_TYPES = ("attack-pattern", "malware", "tool", "intrusion-set", "campaign", "course-of-action", "x-mitre-tactic")


def _line(label: str, values: Column) -> Column:
    """``label: a, b`` or null for an empty list."""
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, F.concat(F.lit(f"{label}: "), F.array_join(values, ", ")))


def first_external_id(references: Column, source: str) -> Column:
    return F.get(F.filter(references, lambda r: r["source_name"] == source), F.lit(0))["external_id"]


def stix_documents(objects: DataFrame) -> DataFrame:
    """Live objects of the known types with a name and a description: (id, type, text).

    Tactics come only from kill chains whose name begins with ``mitre-``.
    """
    live = ~F.coalesce(F.col("revoked"), F.lit(False)) & ~F.coalesce(F.col("x_mitre_deprecated"), F.lit(False))
    named = (F.coalesce("name", F.lit("")) != "") & (F.coalesce("description", F.lit("")) != "")
    phases = F.filter("kill_chain_phases", lambda p: p["kill_chain_name"].startswith("mitre-"))
    tactics = F.transform(phases, lambda p: F.replace(p["phase_name"], F.lit("-"), F.lit(" ")))
    head = F.concat_ws(" ", first_external_id(F.col("external_references"), "mitre-attack"), "name")
    header = F.concat_ws(" | ", head, _line("Aliases", F.col("aliases")), _line("Tactics", tactics), _line("Platforms", F.col("x_mitre_platforms")))
    return objects.where(live & named & F.col("type").isin(*STIX_TYPES)).select("id", "type", F.concat_ws("\n", header, "description").alias("text"))


def english(descriptions: Column, or_first: bool = False) -> Column:
    """The first English description; the first of all where asked and there is none."""
    hit = F.get(F.filter(descriptions, lambda d: d["lang"] == "en"), F.lit(0))["value"]
    return F.coalesce(hit, F.get(descriptions, F.lit(0))["value"]) if or_first else hit


def weakness_ids(weaknesses: Column) -> Column:
    """Distinct English CWE ids in order."""
    values = F.flatten(F.transform(weaknesses, lambda w: F.filter(w["description"], lambda d: d["lang"] == "en")))
    return F.array_distinct(F.filter(F.transform(values, lambda d: d["value"]), lambda v: v.startswith("CWE-")))


def preferred(metrics: Column) -> Column:
    """The first Primary metric, else the first."""
    return F.coalesce(F.get(F.filter(metrics, lambda m: m["type"] == "Primary"), F.lit(0)), F.get(metrics, F.lit(0)))


def cve_documents(rows: DataFrame) -> DataFrame:
    """NVD records (id, published, descriptions, weaknesses, v31, v30, v2) as (id, date, text)."""
    scores = [F.when(F.size(F.coalesce(F.col(v), F.array().cast(rows.schema[v].dataType))) > 0, F.format_string("CVSS %s %.1f %s", F.lit(name), F.get(F.col(v), F.lit(0))["score"], F.get(F.col(v), F.lit(0))["severity"])) for v, name in (("v31", "3.1"), ("v30", "3.0"), ("v2", "2.0"))]
    text = english(F.col("descriptions"))
    header = F.concat_ws(" | ", "id", _line("Weaknesses", weakness_ids(F.col("weaknesses"))), *scores)
    return rows.where(text.isNotNull()).select("id", F.substring("published", 1, 10).alias("date"), F.concat_ws("\n", header, text).alias("text"))


def kev_documents(rows: DataFrame) -> DataFrame:
    """Exploited vulnerabilities with an id and a description."""
    ok = (F.coalesce("cveID", F.lit("")) != "") & (F.coalesce("shortDescription", F.lit("")) != "")
    ransom = F.when(F.lower("knownRansomwareCampaignUse") == "known", "Known ransomware use.")
    text = F.concat_ws("\n", F.concat_ws(" | ", "cveID", "vulnerabilityName", F.concat_ws(" ", "vendorProject", "product")), "shortDescription", F.concat(F.lit("Action: "), "requiredAction"), ransom)
    return rows.where(ok).select(F.col("cveID").alias("id"), F.col("dateAdded").alias("date"), text.alias("text"))


def cwe_documents(rows: DataFrame) -> DataFrame:
    """Weaknesses (id, name, description, extended): white space of the extension squashed."""
    ok = F.col("id").isNotNull() & (F.coalesce("name", F.lit("")) != "") & (F.coalesce("description", F.lit("")) != "")
    ext = F.trim(F.regexp_replace("extended", r"\s+", " "))
    return rows.where(ok).select(F.concat(F.lit("CWE-"), F.col("id").cast("string")).alias("id"), F.concat_ws("\n", F.concat(F.lit("CWE-"), F.col("id").cast("string"), F.lit(" "), "name"), "description", F.when(ext != "", ext)).alias("text"))


def rule_documents(rows: DataFrame) -> DataFrame:
    """Detection rules (id, title, description, logsource map, tags): empty log source values are skipped."""
    ok = (F.coalesce("title", F.lit("")) != "") & (F.coalesce("description", F.lit("")) != "")
    source = F.map_filter("logsource", lambda k, v: F.coalesce(v, F.lit("")) != "")
    pairs = F.array_join(F.transform(F.map_entries(source), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    return rows.where(ok).select("id", F.concat_ws("\n", "title", F.when(pairs != "", F.concat(F.lit("Log source: "), pairs)), "description").alias("text"))


def technique_id(tag: Column) -> Column:
    """``attack.t1059.1`` -> ``T1059.001``; null for other tags."""
    base, sub = F.regexp_extract(tag, r"(?i)^attack\.(t\d{4})(?:\.(\d+))?$", 1), F.regexp_extract(tag, r"(?i)^attack\.(t\d{4})(?:\.(\d+))?$", 2)
    return F.when(base != "", F.when(sub != "", F.concat(F.upper(base), F.lit("."), F.lpad(sub, 3, "0"))).otherwise(F.upper(base)))


def iso_date(value: Column) -> Column:
    """Date-only values get a time, a space becomes ``T``, blanks around colons go; missing is ``N/A``."""
    v = F.regexp_replace(F.trim(value), r"\s*:\s*", ":")
    v = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(v, F.lit("T00:00:00"))).otherwise(F.regexp_replace(v, " ", "T"))
    return F.coalesce(F.when(v != "", v), F.lit("N/A"))


def flexible_time(value: Column) -> Column:
    """ISO first, then the other accepted formats; null where none fits."""
    formats = ["yyyy-MM-dd", "yyyy/MM/dd", "dd-MMM-yyyy", "yyyy-MM-dd HH:mm:ss"]
    return F.coalesce(F.try_to_timestamp(value), *[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def report_digest(text: Column, most: int = 200) -> Column:
    """Hashes out, descriptions cut."""
    return F.substring(F.regexp_replace(text, r"\b[0-9a-fA-F]{32,64}\b", "<hash>"), 1, most)


#: What a sandbox report keeps, in this order, and of each technique in it.
REPORT_KEYS = ("size", "type", "submit_name", "sha256", "av_detect", "vx_family", "threat_score", "threat_level", "verdict", "certificates_validation_message", "total_processes", "total_signatures", "file_metadata", "processes", "mitre_attcks", "network_mode", "signatures")
TECHNIQUE_KEYS = ("tactic", "technique", "attck_id")
SIGNATURE_CHARS = 50


def truncated_reports(df: DataFrame, report: Column, name: str = "report") -> DataFrame:
    """``df`` with reports, JSON as text, cut down: the keys that count, hashes in values written ``hash``, short signature descriptions, three keys of each technique.

    A report without signatures or techniques gets empty lists of them; null where the text is no JSON.
    Each step is a column of its own, since within a function over elements an expression is worked out for each.
    """

    def in_order(pairs: Column, keys: tuple[str, ...]) -> Column:
        place = lambda p: F.array_position(F.array(*[F.lit(k) for k in keys]), p["key"])
        kept = F.filter(pairs, lambda p: p["key"].isin(*keys))
        return F.transform(F.sort_array(F.transform(kept, lambda p: F.struct(place(p).alias("at"), p["key"].alias("key"), p["value"].alias("value")))), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))

    def shortened(p: Column) -> Column:
        cut = json_string(F.substring(json_text(p["value"]), 1, SIGNATURE_CHARS))
        return F.struct(p["key"].alias("key"), F.when(p["key"] == "description", cut).otherwise(p["value"]).alias("value"))

    def lists(p: Column) -> Column:
        joined = lambda items: F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
        signs = F.transform(json_items(p["value"]), lambda x: json_object(F.transform(json_pairs(x), shortened)))
        ways = F.transform(json_items(p["value"]), lambda x: json_object(in_order(json_pairs(x), TECHNIQUE_KEYS)))
        return F.struct(p["key"].alias("key"), F.when(p["key"] == "signatures", joined(signs)).when(p["key"] == "mitre_attcks", joined(ways)).otherwise(p["value"]).alias("value"))

    rows = df.withColumn("_text", report).withColumn("_text", F.when(is_json(F.col("_text")), F.col("_text"))).withColumn("_pairs", json_pairs(F.col("_text")))
    rows = rows.withColumn("_kept", in_order(F.col("_pairs"), REPORT_KEYS))
    rows = rows.withColumn("_kept", F.transform("_kept", lambda p: F.struct(p["key"].alias("key"), map_strings(p["value"], lambda v: F.regexp_replace(v, "[0-9a-f]{32,}", "hash")).alias("value"))))
    rows = rows.withColumn("_kept", F.transform("_kept", lists))
    lacks = lambda key: F.when(F.exists("_kept", lambda p: p["key"] == key), F.slice("_kept", F.lit(1), F.lit(0))).otherwise(F.array(F.struct(F.lit(key).alias("key"), F.lit("[]").alias("value"))))
    out = F.when(F.col("_text").isNotNull(), json_object(F.concat("_kept", lacks("signatures"), lacks("mitre_attcks"))))
    return rows.withColumn(name, out).drop("_text", "_pairs", "_kept")
