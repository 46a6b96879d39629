"""Property graph as DataFrames: nodes by label, edges (src, dst, type), and operators over them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass
class Graph:
    """``nodes[label]`` has ``id`` and properties; ``edges[type]`` has ``src``, ``dst`` and labels of both ends."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, tuple[str, str, DataFrame]] = field(default_factory=dict)

    def add_nodes(self, label: str, rows: DataFrame, key: str = "id") -> None:
        """One row for each key: the first by all columns, so that reloads agree."""
        renamed = rows if key == "id" else rows.withColumnRenamed(key, "id")
        self.nodes[label] = renamed.where("id is not null").dropDuplicates(["id"])

    def add_edges(self, kind: str, src: str, dst: str, rows: DataFrame) -> None:
        """Edges whose ends both exist, each once."""
        ends = rows.select("src", "dst").distinct()
        ends = ends.join(self.nodes[src].select(F.col("id").alias("src")), "src", "left_semi").join(self.nodes[dst].select(F.col("id").alias("dst")), "dst", "left_semi")
        self.edges[kind] = (src, dst, ends)

    def inverse(self, kind: str, name: str) -> None:
        src, dst, rows = self.edges[kind]
        self.edges[name] = (dst, src, rows.select(F.col("dst").alias("src"), F.col("src").alias("dst")))

    def census(self) -> DataFrame:
        """Rows by label and by edge type."""
        from functools import reduce

        parts = [d.agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), F.lit(k).alias("name"), "n") for k, d in self.nodes.items()]
        parts += [d.agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), F.lit(k).alias("name"), "n") for k, (_, _, d) in self.edges.items()]
        return reduce(DataFrame.union, parts)

    def schema_edges(self) -> DataFrame:
        """``(src_type, type, dst_type)`` of the edge types that have an edge."""
        from functools import reduce

        each = [rows.limit(1).select(F.lit(a).alias("src_type"), F.lit(kind).alias("type"), F.lit(b).alias("dst_type")) for kind, (a, b, rows) in self.edges.items()]
        return reduce(DataFrame.union, each)

    def schema_properties(self) -> DataFrame:
        """``(label, property)`` of all properties that some node has, ids apart."""
        from functools import reduce

        def of(label: str, rows: DataFrame) -> DataFrame:
            names = [c for c in rows.columns if c != "id"]
            counts = rows.agg(*[F.count(c).alias(c) for c in names])
            each = F.array(*[F.struct(F.lit(c).alias("property"), (F.col(c) > 0).alias("there")) for c in names])
            return counts.select(F.explode(each).alias("x")).where("x.there").select(F.lit(label).alias("label"), "x.property")

        return reduce(DataFrame.union, [of(k, d) for k, d in self.nodes.items() if len(d.columns) > 1])


def schema_path(edges: DataFrame, start: str, end: str) -> DataFrame:
    """``(step, label)`` of a path of fewest labels, edges taken both ways, the least by names; no rows without one.

    A round goes one edge further from all labels reached, which are met once.
    """
    from kilnspark.sources.workspace import materialise

    ways = edges.select(F.col("src_type").alias("a"), F.col("dst_type").alias("b"))
    ways = materialise(ways.union(ways.select("b", "a")).distinct())
    front = materialise(edges.sparkSession.createDataFrame([(start, [start])], "label string, path array<string>"))
    seen = front.select("label")
    while not front.isEmpty():
        found = front.where(F.col("label") == end)
        if not found.isEmpty():
            return found.select(F.posexplode("path").alias("step", "label")).select((F.col("step") + 1).alias("step"), "label")
        grown = front.join(ways, F.col("label") == F.col("a")).select(F.col("b").alias("label"), F.concat("path", F.array("b")).alias("path"))
        front = materialise(grown.join(seen, "label", "left_anti").groupBy("label").agg(F.min("path").alias("path")))
        seen = seen.union(front.select("label"))
    return front.select(F.lit(0).alias("step"), "label")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def latest(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The last load of each key wins."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_rn = 1").drop("_rn")


#: Links up to which labels travel as broadcasts (16 bytes a label, two labels a link at most).
BROADCAST_LINKS = 1_000_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of the linked nodes; the least node names a component.

    Each round a node takes the least label of itself, its neighbours and its
    own label's node, so that chains halve.  Labels are joined by broadcast
    only behind a count of the links; beyond it the same joins shuffle.
    """
    from kilnspark.sources.workspace import materialise

    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = materialise(links.union(links.select("b", "a")).distinct())
    small = both.count() <= 2 * BROADCAST_LINKS
    side = F.broadcast if small else (lambda df: df)
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        known = labels.select(F.col("node").alias("b"), "label")
        near = both.join(side(known), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        own = near.join(side(labels), "node")
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        best = F.least("near", "label", "far")
        moved = materialise(own.join(side(jump), "label").select("node", best.alias("label"), (best < F.col("label")).alias("moved")))
        labels = moved.select("node", "label")
        if not moved.where("moved").take(1):
            return labels.select("node", F.col("label").alias("component"))


def neighbourhood(up: DataFrame, links: DataFrame) -> DataFrame:
    """Strict and plausible partners of each child of a hierarchy.

    ``up`` has (child, parent), ``links`` has (node, partner).  Strict: the
    node's own partners.  Plausible: those of parent, siblings and children, less the strict.
    """
    # siblings are met through their parent: what all its children have, a node's own partners are strict anyway
    own = links.select(F.col("node").alias("near"), "partner")
    of_parent = up.join(own, up["parent"] == own["near"]).select(F.col("child").alias("node"), "partner")
    of_child = up.join(own, up["child"] == own["near"]).select("parent", "partner").distinct()
    family = up.join(of_child, "parent").select(F.col("child").alias("node"), "partner")
    near = of_parent.union(of_child.select(F.col("parent").alias("node"), "partner")).union(family)
    plausible = near.groupBy("node").agg(F.collect_set("partner").alias("p"))
    strict = links.groupBy("node").agg(F.sort_array(F.collect_set("partner")).alias("strict"))
    joined = strict.join(plausible, "node", "left")
    return joined.select("node", "strict", F.sort_array(F.array_except(F.coalesce("p", F.array().cast(joined.schema["p"].dataType)), "strict")).alias("plausible"))


def star_schema(spark: SparkSession, sf_dir: str) -> Graph:
    """The driver's star schema as a graph: tables are labels, foreign keys are edges."""
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    g = Graph()
    g.add_nodes("region", t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")))
    g.add_nodes("nation", t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
    g.add_nodes("customer", t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")))
    g.add_nodes("supplier", t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
    g.add_nodes("order", t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")))
    edge = lambda n, a, b: t(n).select(F.col(a).alias("src"), F.col(b).alias("dst"))
    g.add_edges("part_of", "nation", "region", edge("nation", "n_nationkey", "n_regionkey"))
    g.add_edges("lives_in", "customer", "nation", edge("customer", "c_custkey", "c_nationkey"))
    g.add_edges("based_in", "supplier", "nation", edge("supplier", "s_suppkey", "s_nationkey"))
    g.add_edges("placed", "customer", "order", edge("orders", "o_custkey", "o_orderkey"))
    g.inverse("lives_in", "home_of")
    return g
