"""Balancing, sampling and splitting.

Random choice is an order by ``md5(seed|key)``: any engine can repeat it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.operators.numbering import numbered
from kilnspark.operators.skew import join_counted
from kilnspark.sources.workspace import materialise


def draw(seed: str, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))


def interleave(df: DataFrame, family: str, key: str, seed: str) -> DataFrame:
    """Stride interleave: family ``f`` with k of N rows takes positions (i - 0.5) * N / k.

    Places within a family come from ranges of the drawn order, so that a family may be of any size.
    """
    sizes = df.groupBy(family).agg(F.count("*").alias("_size"))
    total = sizes.agg(F.sum("_size").alias("_all"))
    ranked = numbered(df.withColumn("_draw", draw(seed, key)), ["_draw", key], "_rank", family)
    out = ranked.join(sizes, ranked[family].eqNullSafe(sizes[family])).drop(sizes[family]).crossJoin(F.broadcast(total))
    return out.withColumn("pos", (F.col("_rank") + 0.5) * F.col("_all") / F.col("_size")).select(*df.columns, "pos")


#: Hexadecimal digits of the draw that make a bin: 65,536 of them.
BIN_DIGITS = 4


def firsts(df: DataFrame, family: list[str], key: str, seed: str, take: Callable[[Column], Column | int]) -> DataFrame:
    """``df`` with ``_first``: whether a row is among the first of its family in drawn order, ``take`` of the family's size many.

    Nothing sorts a family.  Draws are counted by family and bin; the bin in which
    the number is reached parts those before it, which all count, from those after
    it, and only its own rows, one in 65,536 or so, are ranked.  Nulls are a family.
    """
    tag = F.to_json(F.array(*[F.col(c).cast("string") for c in family]))
    rows = df.withColumn("_f", tag).withColumn("_d", draw(seed, key)).withColumn("_bin", F.conv(F.substring("_d", 1, BIN_DIGITS), 16, 10).cast("int"))
    bins = materialise(rows.groupBy("_f", "_bin").agg(F.count("*").alias("_n")))
    whole = Window.partitionBy("_f")
    upto = F.sum("_n").over(whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    known = bins.withColumn("_size", F.sum("_n").over(whole)).withColumn("_upto", upto)
    wanted = take(F.col("_size"))
    known = known.withColumn("_k", F.least(F.lit(wanted) if isinstance(wanted, int) else wanted, F.col("_size")))
    reached = F.col("_upto") >= F.col("_k")
    plan = known.groupBy("_f").agg(F.max("_size").alias("_size"), F.min(F.when(reached, F.col("_bin"))).alias("_border"), F.min_by(F.col("_k") - F.col("_upto") + F.col("_n"), F.when(reached, F.col("_bin"))).alias("_left"), F.min_by("_n", F.when(reached, F.col("_bin"))).alias("_in"))
    plan = materialise(plan)
    total = plan.agg(F.sum("_size")).first()[0] or 0
    met = join_counted(rows, plan, "_f", "_size", total)
    sure = (F.col("_bin") < F.col("_border")) | ((F.col("_bin") == F.col("_border")) & (F.col("_left") >= F.col("_in")))
    open_ = (F.col("_bin") == F.col("_border")) & (F.col("_left") < F.col("_in"))
    ranked = F.row_number().over(Window.partitionBy("_f").orderBy("_d", key)) <= F.col("_left")
    clear = met.where(~open_).withColumn("_first", sure)
    return clear.unionByName(met.where(open_).withColumn("_first", ranked)).select(*df.columns, "_first")


def cap(df: DataFrame, family: str, key: str, most: int, seed: str, preserve: str | None = None) -> DataFrame:
    """At most ``most`` rows of each family; families with the preserved prefix stay whole."""
    kept = F.coalesce(F.col(family).startswith(preserve), F.lit(False)) if preserve else F.lit(False)
    return firsts(df, [family], key, seed, lambda n: most).where(F.col("_first") | kept).drop("_first")


def sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows; n <= 0 keeps all."""
    return df if n <= 0 else df.orderBy(draw(seed, key), key).limit(n)


def two_caps(df: DataFrame, actor: str, family: str, key: str, per_actor: int, per_family: int, seed: str) -> DataFrame:
    """Cap each actor, then each family; rows without an actor meet only the second cap."""
    named = firsts(df.where(F.col(actor).isNotNull()), [family, actor], key, seed, lambda n: per_actor).where("_first").drop("_first")
    first = materialise(named.unionByName(df.where(F.col(actor).isNull())))
    return firsts(first, [family], key, seed, lambda n: per_family).where("_first").drop("_first")


def validation_slice(df: DataFrame, axis: str, key: str, most: int, seed: str) -> DataFrame:
    """Column ``split``: val for up to ``most`` rows of each axis, train for the others."""
    return firsts(df, [axis], key, seed, lambda n: most).withColumn("split", F.when(F.col("_first"), "val").otherwise("train")).drop("_first")


def fraction(df: DataFrame, group: str, key: str, share: float, seed: str) -> DataFrame:
    """ceil(share * n) rows of each group, one at least."""
    return firsts(df, [group], key, seed, lambda n: F.greatest(F.lit(1), F.ceil(F.lit(share) * n))).where("_first").drop("_first")


def resample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Whole copies first, then a drawn rest, to reach ``n`` rows; column ``copy`` from 0."""
    total = df.agg(F.count("*").alias("_all"))
    ranked = numbered(df.withColumn("_draw", draw(seed, key)), ["_draw", key], "_at").crossJoin(F.broadcast(total))
    copies = F.floor(F.lit(n) / F.col("_all")) + F.when(F.col("_at") < F.lit(n) % F.col("_all"), 1).otherwise(0)
    copied = F.explode(F.when(copies > 0, F.sequence(F.lit(0), (copies - 1).cast("int"))).otherwise(F.array().cast("array<int>")))
    return ranked.withColumn("copy", copied).select(*df.columns, "copy")


def _place(seed: str, *keys: Column) -> Column:
    """A drawn number from 0 to below 1 by the md5 of the keys."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys])), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draws(df: DataFrame, key: str, n: int, seed: str, first: int = 0) -> DataFrame:
    """``n`` rows drawn with replacement: draw i takes the row at its hashed place in the order of ``key``; column ``draw`` from ``first``."""
    rows = numbered(df, [key], "_at")
    total = df.agg(F.count("*").alias("_all"))
    slots = df.sparkSession.range(first, first + n).withColumnRenamed("id", "draw").crossJoin(F.broadcast(total)).where("_all > 0")
    slots = slots.withColumn("_at", F.floor(_place(seed, F.col("draw")) * F.col("_all")))
    return slots.select("draw", "_at").join(rows, "_at").drop("_at")


def resample_drawn(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows: a drawn order of all rows first, then rows drawn with replacement; column ``draw`` from 0."""
    size = df.count()
    once = numbered(df.withColumn("_draw", draw(seed, key)), ["_draw", key], "draw").drop("_draw").where(F.col("draw") < n)
    return once.unionByName(draws(df, key, n - size, seed, size)) if n > size else once


def resample_weighted(df: DataFrame, key: str, seed: str, size: int | None = None, weight: float | None = None) -> DataFrame:
    """Rows drawn with replacement: ``size`` of them, then ``weight`` times as many of those."""
    if size is not None:
        df = draws(df, key, size, seed).drop("draw")
    if weight is not None:
        df = draws(df, key, int(df.count() * weight), f"{seed}w").drop("draw")
    return df


def split_sizes(rows: int, val: float) -> int:
    """Rows of the validation part: a share below 1, else a count; all rows at most."""
    if val < 0:
        raise ValueError("the validation size is negative")
    return min(rows, int(rows * val) if val < 1 else int(val))


def train_val(df: DataFrame, key: str, val: float, seed: str) -> DataFrame:
    """Column ``split``: val for the first rows of a drawn order, a share or a count of them."""
    most = split_sizes(df.count(), val)
    ranked = numbered(df.withColumn("_draw", draw(seed, key)), ["_draw", key], "_at")
    return ranked.select(*df.columns, F.when(F.col("_at") < most, "val").otherwise("train").alias("split"))


def _chosen(spark, weights: dict[str, float], slots: int, seed: str) -> DataFrame:
    """(slot, dataset, turn): a slot takes a dataset by its drawn place in the cumulative weights; turns count a dataset's slots."""
    place = _place(seed, F.col("slot"))
    name, upto, bounds = F.lit(list(weights)[-1]), 0.0, []
    for d, w in weights.items():
        upto += w
        bounds.append((d, upto))
    for d, top in reversed(bounds[:-1]):
        name = F.when(place < top, d).otherwise(name)
    return numbered(spark.range(slots).withColumnRenamed("id", "slot").withColumn("dataset", name), ["slot"], "turn", "dataset")


def _parts(parts: dict[str, DataFrame], key: str) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("dataset"), F.col(key)) for n, d in parts.items()])
    return numbered(rows, [key], "at", "dataset")


def mix_interleave(parts: dict[str, DataFrame], weights: dict[str, float], key: str, slots: int, seed: str) -> DataFrame:
    """A fixed number of slots, each with its dataset's next row, cycling: (slot, dataset, key)."""
    rows = _parts(parts, key)
    sizes = rows.groupBy("dataset").agg(F.count("*").alias("n"))
    chosen = _chosen(rows.sparkSession, weights, slots, seed).join(F.broadcast(sizes), "dataset").withColumn("at", F.col("turn") % F.col("n"))
    return chosen.join(rows, ["dataset", "at"]).select("slot", "dataset", key)


def mix_until(parts: dict[str, DataFrame], weights: dict[str, float], key: str, seed: str, stop: str) -> DataFrame:
    """Slots drawn by weight until ``stop``: (slot, dataset, key).

    ``under``: right after the last row of the first dataset that ends; ``over``:
    after all have ended once, those that end sooner begin anew; ``once``: each row
    once, slots of a dataset that has ended are skipped.
    """
    if stop not in ("under", "over", "once"):
        raise ValueError(f"unknown stopping rule {stop}")
    rows = _parts(parts, key)
    sizes = {r["dataset"]: r["n"] for r in rows.groupBy("dataset").agg(F.count("*").alias("n")).collect()}  # one row for each dataset
    if set(sizes) != set(weights):
        raise ValueError("a dataset is empty or has no weight")
    slots = int(2 * max(n / weights[d] for d, n in sizes.items())) + 100
    while True:
        chosen = _chosen(rows.sparkSession, weights, slots, seed)
        counts = F.broadcast(chosen.sparkSession.createDataFrame(list(sizes.items()), "dataset string, n long"))
        sized = chosen.join(counts, "dataset")
        ends = {r["dataset"]: r["slot"] for r in sized.where("turn = n - 1").select("dataset", "slot").collect()}
        if len(ends) == len(sizes):
            break
        slots *= 2
    if stop == "once":
        kept = sized.where("turn < n")
    else:
        kept = sized.where(F.col("slot") <= (min if stop == "under" else max)(ends.values()))
    return kept.withColumn("at", F.col("turn") % F.col("n")).join(rows, ["dataset", "at"]).select("slot", "dataset", key)


def shard(df: DataFrame, name: Column) -> DataFrame:
    """Column ``shard`` from an ordered CASE."""
    return df.withColumn("shard", name)


def first_by(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")
