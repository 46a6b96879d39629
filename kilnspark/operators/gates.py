"""Corpus gates: counts, licenses, letter balance, invariants."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.operators.filters import license_verdict, wildcard
from kilnspark.operators.graph import Graph


def row_counts(df: DataFrame, name: str, axes: DataFrame) -> DataFrame:
    """Verdict of each axis; ``axes`` has axis, pattern, low, high.  Axes may overlap.

    Names are counted first, so the pattern join meets one row for each name; the
    axes are a plan of a few rows and are broadcast.
    """
    names = df.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n"))
    found = names.join(F.broadcast(axes), wildcard(F.col("name"), F.col("pattern"))).groupBy("axis", "low", "high").agg(F.sum("n").alias("n"))
    hit = axes.select("axis", "low", "high").distinct().join(found, ["axis", "low", "high"], "left")
    got = hit.groupBy("axis", "low", "high").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    verdict = F.when(F.col("rows") < F.col("low"), "FAIL_LOW").when(F.col("rows") > F.col("high"), "FAIL_HIGH").otherwise("OK")
    return got.select("axis", "rows", verdict.alias("verdict"))


def licenses(df: DataFrame, tag, key: str, examples: int = 5) -> DataFrame:
    """Counts by tag and verdict with the first few keys."""
    tagged = df.select(F.coalesce(tag, F.lit("<MISSING>")).alias("tag"), F.col(key).alias("key"))
    counts = tagged.groupBy("tag").agg(F.count("*").alias("n"))
    rn = F.row_number().over(Window.partitionBy("tag").orderBy("key"))
    some = tagged.withColumn("rn", rn).where(F.col("rn") <= examples).groupBy("tag").agg(F.sort_array(F.collect_list("key")).alias("examples"))
    return counts.join(some, "tag").select("tag", "n", license_verdict(F.col("tag")).alias("verdict"), "examples")


def letter_balance(df: DataFrame, letters: str, low: float = 8.0, high: float = 32.0, top: float = 15.0, combos: int = 20) -> DataFrame:
    """One row: shares of A-E within the band, the top combination below its limit, enough combinations.

    Without parsed rows the gate fails.
    """
    rows = df.where(F.col(letters).isNotNull() & (F.size(letters) > 0))
    by_letter = rows.select(F.explode(letters).alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    share = by_letter.agg(F.sum("n").alias("all"), *[F.sum(F.when(F.col("x") == c, F.col("n")).otherwise(0)).alias(c) for c in "ABCDE"])
    combo = rows.groupBy(F.array_join(letters, "").alias("c")).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows"), F.count("*").alias("combos"))
    inside = F.lit(True)
    for c in "ABCDE":
        pct = 100.0 * F.col(c) / F.col("all")
        inside = inside & pct.between(low, high)
    ok = inside & (100.0 * F.col("most") / F.col("rows") < top) & (F.col("combos") >= combos)
    return share.crossJoin(combo).select(F.coalesce("rows", F.lit(0)).alias("rows"), "combos", *[F.round(100.0 * F.col(c) / F.col("all"), 6).alias(f"pct_{c}") for c in "ABCDE"], F.coalesce(ok, F.lit(False)).alias("ok"))


def leak_overlap(train: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Train rows that are not in the held-out rows; null equals the empty string."""
    test = None
    right = held.select(*[F.coalesce(F.col(k), F.lit("")).alias(f"_{k}") for k in keys]).distinct()
    for k in keys:
        one = F.coalesce(F.col(k), F.lit("")) == F.col(f"_{k}")
        test = one if test is None else test & one
    return train.join(right, test, "left_anti")


def invariants(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows, distinct texts and their share, empty texts; one row."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(F.sha1(text)).alias("distinct_texts"), F.count_if(F.coalesce(F.trim(text), F.lit("")) == "").alias("empty_texts"), F.countDistinct(key).alias("distinct_keys"))


@dataclass(frozen=True)
class Floor:
    """What a graph must have: nodes of ``label``, with ``prop`` set and over ``chars`` long, with an ``edge`` that leaves them; or edges alone."""

    floor: int
    label: str | None = None
    prop: str | None = None
    chars: int | None = None
    edge: str | None = None

    @property
    def name(self) -> str:
        text = f"{self.label}.{self.prop}" if self.prop else self.label
        text = f"{text} over {self.chars}" if self.chars is not None else text
        return text if not self.edge else self.edge if not self.label else f"{self.edge} from {text}"


def floors(graph: Graph, wanted: list[Floor]) -> DataFrame:
    """``(name, got, floor, ok)`` of each floor; a label or edge that the graph lacks has -1."""
    spark = next(iter(graph.nodes.values())).sparkSession

    def one(f: Floor) -> DataFrame:
        if (f.label and f.label not in graph.nodes) or (f.edge and f.edge not in graph.edges) or (f.prop and f.prop not in graph.nodes[f.label].columns):
            rows = spark.range(1).select(F.lit(-1).cast("long").alias("got"))
        elif not f.label:
            rows = graph.edges[f.edge][2].agg(F.count("*").alias("got"))
        else:
            nodes = graph.nodes[f.label]
            if f.prop:
                nodes = nodes.where(F.col(f.prop).isNotNull())
            if f.chars is not None:
                nodes = nodes.where(F.length(F.col(f.prop).cast("string")) > f.chars)
            if f.edge:
                nodes = nodes.join(graph.edges[f.edge][2].select(F.col("src").alias("id")), "id", "left_semi")
            rows = nodes.agg(F.count("*").alias("got"))
        return rows.select(F.lit(f.name).alias("name"), "got", F.lit(f.floor).alias("floor"), (F.col("got") >= f.floor).alias("ok"))

    return reduce(DataFrame.union, map(one, wanted))
