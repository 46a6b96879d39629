"""Node and edge builders of the knowledge graph."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.functions.extract import uuid5
from kilnspark.operators.graph import Graph
from kilnspark.operators.render import technique_id
from kilnspark.operators.stix import object_nodes


def entity_id(namespace: str, name: Column) -> Column:
    """Deterministic id of an entity: version-5 UUID under a DNS name."""
    return uuid5(uuid.uuid5(uuid.NAMESPACE_DNS, namespace).bytes, name)


def year_from(cve: Column, first: int) -> Column:
    """CVE ids of the year on."""
    return F.coalesce(F.try_element_at(F.split(cve, "-"), F.lit(2)).cast("int") >= first, F.lit(False))


def add_stix(graph: Graph, objects: DataFrame, labels: list[str]) -> None:
    """Nodes of each type with all its properties."""
    for label in labels:
        graph.add_nodes(label, object_nodes(objects, label))


def add_relationships(graph: Graph, objects: DataFrame) -> None:
    """Relationships whose two ends are known labels; others are skipped."""
    label = lambda c: F.substring_index(c, "--", 1)
    rels = objects.where("type = 'relationship'").select("relationship_type", "source_ref", "target_ref", label("source_ref").alias("s"), label("target_ref").alias("d")).where(F.col("s").isin(*graph.nodes) & F.col("d").isin(*graph.nodes))
    kinds = rels.select("relationship_type", "s", "d").distinct().collect()  # as many rows as the schema has edge types
    for k in kinds:
        rows = rels.where((F.col("relationship_type") == k[0]) & (F.col("s") == k[1]) & (F.col("d") == k[2]))
        graph.add_edges(f"{k[1]}.{k[0]}.{k[2]}", k[1], k[2], rows.select(F.col("source_ref").alias("src"), F.col("target_ref").alias("dst")))


def achieves(techniques: DataFrame, tactics: DataFrame) -> DataFrame:
    """Technique to tactic: kill-chain phase equals short name."""
    phases = techniques.select(F.col("id").alias("src"), F.explode("kill_chain_phases").alias("p")).select("src", F.col("p.phase_name").alias("shortname"))
    return phases.join(tactics.select("shortname", F.col("id").alias("dst")), "shortname").select("src", "dst").distinct()


def rule_techniques(rules: DataFrame, techniques: DataFrame) -> DataFrame:
    """Rule to technique by normalised tag."""
    tags = rules.select(F.col("id").alias("src"), F.explode("tags").alias("tag")).select("src", technique_id(F.col("tag")).alias("mitre_id")).where("mitre_id is not null")
    return tags.join(techniques.select("mitre_id", F.col("id").alias("dst")), "mitre_id").select("src", "dst").distinct()


def cve_weaknesses(cves: DataFrame, weaknesses: DataFrame) -> DataFrame:
    """CVE to weakness by id, else by the first id in the description."""
    key = F.coalesce(F.when(F.coalesce("cwe_id", F.lit("")) != "", F.col("cwe_id")), F.when(F.regexp_extract("description", r"(CWE-\d+)", 1) != "", F.regexp_extract("description", r"(CWE-\d+)", 1)))
    return cves.select(F.col("id").alias("src"), key.alias("cwe")).join(weaknesses.select(F.col("cwe_id").alias("cwe"), F.col("id").alias("dst")), "cwe").select("src", "dst").distinct()


def exploit_edges(entries: DataFrame, first_year: int = 2024) -> DataFrame:
    """One edge for each CVE in the codes field, split at ``;`` and ``,``."""
    codes = entries.select(F.col("id").alias("src"), F.explode(F.split("codes", "[;,]")).alias("dst")).select("src", F.upper(F.trim("dst")).alias("dst"))
    return codes.where(F.col("dst").startswith("CVE-") & year_from(F.col("dst"), first_year)).distinct()


def scoped_mitigations(rows: DataFrame) -> DataFrame:
    """Mitigations numbered within their weakness: ``CWE-x_MIT-y``."""
    return rows.select("cwe_id", F.posexplode("mitigations").alias("n", "text")).select(F.concat("cwe_id", F.lit("_MIT-"), F.col("n") + 1).alias("id"), "cwe_id", "text")


def first_counters(rows: DataFrame) -> DataFrame:
    """(id, technique) once, the first relation in load order stays."""
    return rows.groupBy("id", "technique").agg(F.min_by("relation", "seq").alias("relation"))
