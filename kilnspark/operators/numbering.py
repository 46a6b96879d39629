"""Places of rows in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.sources.workspace import materialise


def numbered(df: DataFrame, order: list[Column | str], name: str = "at", by: str | None = None) -> DataFrame:
    """``df`` with the place of each row from 0 (of its group ``by``) in the order given, which must be total.

    Rows are dealt by ranges of the order and written; each range is numbered on
    its own, and the counts of the ranges before are added.  The driver sees nothing but the plan.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *([F.col(by)] if by else []), *keys).withColumn("_part", F.spark_partition_id())
    rows = materialise(dealt)
    groups = [by] if by else []
    counts = rows.groupBy("_part", *groups).agg(F.count("*").alias("_n"))
    # as many rows as there are ranges, and one more for each group that ends in one
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*keys))
    out = rows.withColumn("_place", place).join(offsets, ["_part", *groups])
    return out.withColumn(name, (F.col("_place") + F.col("_before") - 1).cast("long")).select(*df.columns, name)
