"""Joins whose keys may be hot, without trusting the optimizer to notice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has over one in so many of all rows, which bounds the hot ones.
HOT_SHARE = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join with ``keyed``, which has each ``key`` once and its ``count`` among ``total`` rows.

    At most ``HOT_SHARE`` keys have over ``total`` / ``HOT_SHARE`` rows: they are
    broadcast; rows of the others are shuffled.  ``keyed`` has flat columns of bounded size.
    """
    others = [c for c in keyed.columns if c != key]
    hot = keyed.where(F.col(count) * HOT_SHARE > total).select(key, *[F.col(c).alias(f"_{c}") for c in others])
    tried = rows.join(F.broadcast(hot), key, "left")
    found = tried.where(F.col(f"_{count}").isNotNull()).select(*rows.columns, *[F.col(f"_{c}").alias(c) for c in others])
    rest = tried.where(F.col(f"_{count}").isNull()).select(*rows.columns).join(keyed, key)
    return found.unionByName(rest)


def join_replicated(pairs: DataFrame, values: DataFrame, key: str, step: int = 4096) -> DataFrame:
    """Inner join with ``values``, which has each ``key`` once, in a copy for each ``step`` of the key's pairs, about.

    For values too large to broadcast: a hot key's pairs meet as many copies in as many places.
    """
    wanted = pairs.groupBy(key).agg(F.count("*").alias("_n"))
    copies = values.join(wanted, key).withColumn("_copies", F.ceil(F.col("_n") / step).cast("int")).drop("_n")
    few = wanted.where(F.col("_n") > step).select(key, F.ceil(F.col("_n") / step).cast("int").alias("_c"))
    # by what the pair holds: a row that is worked out again goes to the same place
    dealt = F.xxhash64(*[c for c, kind in pairs.dtypes if c != key and not kind.startswith("array")])
    spread = pairs.join(F.broadcast(few), key, "left").withColumn("_salt", F.when(F.col("_c").isNull(), 0).otherwise(F.pmod(dealt, F.col("_c"))).cast("int")).drop("_c")
    return spread.join(copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies"), [key, "_salt"]).drop("_salt")
