"""Object files as graphs: the public object types with all their properties, and graphs by configured paths."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.functions.answers import navigate
from kilnspark.functions.nested import spaced_json
from kilnspark.operators.render import first_external_id, iso_date
from kilnspark.sources.publish import Published

#: Properties that all object types have, and those of each type.
COMMON = ("id", "type", "name", "description", "created", "modified", "mitre_id", "x_mitre_deprecated", "x_mitre_domains", "x_mitre_version")
PROPERTIES = {
    "attack-pattern": ("external_references", "kill_chain_phases", "x_mitre_data_sources", "x_mitre_detection", "x_mitre_is_subtechnique", "x_mitre_platforms", "x_mitre_attack_spec_version"),
    "campaign": ("external_references", "aliases", "first_seen", "last_seen", "revoked", "x_mitre_attack_spec_version"),
    "course-of-action": ("external_references", "spec_version", "x_mitre_attack_spec_version", "x_mitre_modified_by_ref"),
    "intrusion-set": ("external_references", "aliases", "revoked", "x_mitre_attack_spec_version"),
    "malware": ("external_references", "is_family", "revoked", "x_mitre_aliases", "x_mitre_platforms", "x_mitre_attack_spec_version"),
    "tool": ("external_references", "created_by_ref", "revoked", "x_mitre_aliases", "x_mitre_platforms"),
    "x-mitre-data-component": ("revoked",),
    "x-mitre-data-source": ("revoked", "x_mitre_attack_spec_version"),
    "x-mitre-tactic": ("external_references", "x_mitre_shortname", "x_mitre_attack_spec_version"),
    "x-mitre-analytic": ("external_references", "created_by_ref", "x_mitre_platforms", "x_mitre_attack_spec_version", "x_mitre_log_source_references", "x_mitre_mutable_elements"),
    "x-mitre-detection-strategy": ("external_references", "created_by_ref", "x_mitre_attack_spec_version", "x_mitre_analytic_refs"),
}
DATES = ("created", "modified", "first_seen", "last_seen")
LISTS = ("aliases", "x_mitre_aliases", "x_mitre_domains", "x_mitre_platforms", "x_mitre_data_sources", "x_mitre_analytic_refs")
FLAGS = ("revoked", "is_family", "x_mitre_deprecated", "x_mitre_is_subtechnique")
NESTED = ("external_references", "kill_chain_phases", "x_mitre_log_source_references", "x_mitre_mutable_elements")


def _property(objects: DataFrame, name: str) -> Column:
    """A property in its kind's form: dates normalised, lists empty, flags false, nested values as JSON, texts ``N/A`` where missing."""
    if name == "mitre_id":
        there = "external_references" in objects.columns
        return F.coalesce(first_external_id(F.col("external_references"), "mitre-attack"), F.lit("N/A")) if there else F.lit("N/A")
    given = F.col(name) if name in objects.columns else F.lit(None)
    if name in DATES:
        return iso_date(given.cast("string"))
    if name in LISTS:
        return F.coalesce(given.cast("array<string>"), F.array().cast("array<string>"))
    if name in FLAGS:
        return F.coalesce(given.cast("boolean"), F.lit(False))
    if name in NESTED:
        return F.coalesce(spaced_json(F.to_json(given)), F.lit("[]")) if name in objects.columns else F.lit("[]")
    return F.coalesce(given.cast("string"), F.lit("N/A"))


def object_nodes(objects: DataFrame, label: str) -> DataFrame:
    """Nodes of one of the public types, with all of its properties; each id once."""
    names = [*COMMON, *PROPERTIES[label]]
    rows = objects.where((F.col("type") == label) & F.col("id").isNotNull())
    return rows.select(*[_property(objects, n).alias(n) for n in names]).dropDuplicates(["id"])


def derived_edges(objects: DataFrame) -> dict[str, DataFrame]:
    """``requires_data``: analytic to the data components that its log sources name; ``implemented_by``: strategy to its analytics.  Both ends are objects that are there."""
    of = lambda label: objects.where(F.col("type") == label).select(F.col("id").alias("dst")).distinct()
    logs = objects.where("type = 'x-mitre-analytic'").select(F.col("id").alias("src"), F.explode("x_mitre_log_source_references").alias("l")).select("src", F.col("l.x_mitre_data_component_ref").alias("dst"))
    parts = objects.where("type = 'x-mitre-detection-strategy'").select(F.col("id").alias("src"), F.explode("x_mitre_analytic_refs").alias("dst"))
    return {
        "requires_data": logs.join(of("x-mitre-data-component"), "dst", "left_semi").select("src", "dst").distinct(),
        "implemented_by": parts.join(of("x-mitre-analytic"), "dst", "left_semi").select("src", "dst").distinct(),
    }


# ---------------------------------------------------------------- graphs by configured paths


@dataclass(frozen=True)
class Link:
    """Edges of ``kind`` from nodes of one type to those of another whose ``key`` path yields what their ``link`` path lists."""

    kind: str
    source: str
    link: str
    target: str
    key: str


@dataclass(frozen=True)
class GraphConfig:
    """Where a document keeps its objects and an object its parts; paths as in ``navigate``."""

    objects: str
    id: str = "id"
    type: str = "type"
    public_id: str = "id"
    relation: str = "relationship"
    kind: str = "relationship_type"
    source: str = "source_ref"
    target: str = "target_ref"
    skip: tuple[str, ...] = ()
    links: tuple[Link, ...] = field(default=())


def configured_graph(documents: DataFrame, config: GraphConfig) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): ``(label, id, public_id, properties)`` and ``(kind, id, src, dst)`` of documents of nested columns.

    A node without public id is known by its own; properties are the whole object as
    JSON.  Links are made of properties after the listed relations; a value that no node has makes no edge.
    """
    whole = F.struct(*[F.col(c) for c in documents.columns])
    rows = documents.select(F.explode(navigate(whole, config.objects)).alias("o"))
    first = lambda path: F.get(navigate(F.col("o"), path), F.lit(0)).cast("string")
    rows = rows.select("o", first(config.id).alias("id"), first(config.type).alias("label"))
    things = rows.where((F.col("label") != config.relation) & ~F.col("label").isin(*config.skip) if config.skip else F.col("label") != config.relation)
    nodes = things.select("label", "id", F.coalesce(first(config.public_id), F.col("id")).alias("public_id"), F.to_json("o").alias("properties")).dropDuplicates(["id"])
    parts = [rows.where(F.col("label") == config.relation).select(first(config.kind).alias("kind"), "id", first(config.source).alias("src"), first(config.target).alias("dst"))]
    for x in config.links:
        keys = things.where(F.col("label") == x.target).select(F.explode(navigate(F.col("o"), x.key).cast("array<string>")).alias("_key"), F.col("id").alias("dst"))
        listed = things.where(F.col("label") == x.source).select(F.col("id").alias("src"), F.explode(navigate(F.col("o"), x.link).cast("array<string>")).alias("_key"))
        made = listed.join(keys, "_key").select("src", "dst").distinct()
        parts.append(made.select(F.lit(x.kind).alias("kind"), F.concat_ws("-", F.lit(config.relation), F.lit(x.kind), "src", "dst").alias("id"), "src", "dst"))
    return nodes, reduce(DataFrame.unionByName, parts)


def create_graph(root: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Write a whole graph at once and count it: (part, name, n), edges whose ends are there.

    Nodes are published first, edges after them; a graph that exists already is an error.
    """
    spark = nodes.sparkSession
    held, links = Published(spark, f"{root}/nodes"), Published(spark, f"{root}/edges")
    if held.head() or links.head():
        raise ValueError(f"there is a graph at {root}")
    held.publish(nodes.dropDuplicates(["id"]))
    ids = held.read().select("id")
    ends = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    links.publish(ends.dropDuplicates(["kind", "src", "dst"]))
    counts = held.read().groupBy(F.lit("node").alias("part"), F.col("label").alias("name")).agg(F.count("*").alias("n"))
    return counts.unionByName(links.read().groupBy(F.lit("edge").alias("part"), F.col("kind").alias("name")).agg(F.count("*").alias("n")))
