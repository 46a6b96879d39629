"""Near-duplicate texts by MinHash: against benchmark items, and within a corpus with the first one winning.

A text's set is its distinct shingles of 13 tokens, its signature 128 least
values under as many hash functions.  Bands of the signature retrieve
candidates, exact Jaccard similarity on whole sets decides; texts with fewer
tokens than a shingle have no set and are near to nothing.

Within a corpus a text is kept if no kept text before it is near: the greedy
set in the order of ids, not the least id of a component.  It is settled in
rounds.  Whoever is first in all of its buckets has nobody before it to wait
for: it is kept, and the members of its buckets are compared with it alone, so
a group of copies costs a star, not all pairs.  After ``STARS`` rounds the few
texts still open are joined by their rarest shingles, which is exact and never
meets at common passages; then each round of the pairs found settles whoever
has no open neighbour before it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from kilnspark.functions.text import shingle_tokens
from kilnspark.operators.curate import quality_flag
from kilnspark.operators.skew import join_counted, join_replicated
from kilnspark.sources.workspace import materialise

PERMUTATIONS = 128
SHINGLE = 13
#: Rows in a band.  At 0.8 a pair shares no band of four rows with probability 5e-8; at 0.3 none of one row with 1e-20.
ROWS_WITHIN, ROWS_ITEMS = 4, 1
STARS = 3
#: Signatures of benchmark items that are broadcast (16 bytes each).
BROADCAST_KEYS = 4_000_000

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """Least values of (factor * x + shift) mod 2**64 for each function, as signed longs; needs one shingle."""
    x = shingles.astype(np.int64).view(np.uint64)
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(x), 2048):
        np.minimum(least, (x[at : at + 2048, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    return least.view(np.int64)


@F.pandas_udf(ArrayType(LongType()))
def signature(shingles: pd.Series) -> pd.Series:
    """128 least values of each set; null for none."""
    return shingles.map(lambda s: None if s is None or len(s) == 0 else minhash(np.asarray(s)))


def shingle_sets(texts: DataFrame, id_col: str, text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(id, sh)``: hashes of the distinct shingles, of texts that have one."""
    tokens = F.transform(shingle_tokens(F.col(text_col)), lambda t: F.xxhash64(t))
    rows = texts.select(F.col(id_col).alias("id"), tokens.alias("t")).where(F.size("t") >= width)
    runs = F.transform(F.sequence(F.lit(1), F.size("t") - (width - 1)), lambda i: F.xxhash64(F.slice("t", i, width)))
    return rows.select("id", F.array_distinct(runs).alias("sh"))


def _bands(sets: DataFrame, rows: int) -> DataFrame:
    """``(id, key)`` of each band."""
    signed = sets.select("id", signature("sh").alias("sig"))
    bands = [F.xxhash64(F.lit(b), F.slice("sig", b + 1, rows)) for b in range(0, PERMUTATIONS, rows)]
    return signed.select("id", F.explode(F.array(*bands)).alias("key"))


def _similar(a: str, b: str, threshold: float) -> Column:
    """Exact Jaccard of two sets at ``threshold`` at least, in whole numbers of thousandths."""
    shared = F.size(F.array_intersect(a, b))
    return shared * 1000 >= (F.size(a) + F.size(b) - shared) * round(threshold * 1000)


def near_items(sets: DataFrame, items: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(id)`` of the sets near an item of ``items`` (``id``, ``sh``)."""
    known = items.withColumnRenamed("sh", "item_sh").withColumnRenamed("id", "item")
    keys = materialise(_bands(items, ROWS_ITEMS).withColumnRenamed("id", "item").distinct())
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    pairs = _bands(sets, ROWS_ITEMS).join(side, "key").select("id", "item").distinct()
    near = join_replicated(pairs.join(sets, "id"), known, "item").where(_similar("sh", "item_sh", threshold))
    return near.select("id").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The ``(id, before)`` pairs that are near."""
    held = join_replicated(pairs, sets, "id")
    return join_replicated(held, sets.select(F.col("id").alias("before"), F.col("sh").alias("before_sh")), "before").where(_similar("sh", "before_sh", threshold)).select("id", "before")


def rare_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """``(id, before)`` that share one of their rarest shingles: all pairs at ``threshold``, and others.

    A near pair shares ``threshold`` of either set, so of the ``n`` shingles of a
    set in any one order the first ``n - ceil(threshold * n) + 1`` hold a common one.
    """
    each = sets.select("id", F.explode("sh").alias("s"))
    common = materialise(each.groupBy("s").agg(F.count("*").alias("n")).where("n > 1"))
    total = common.agg(F.sum("n")).first()[0] or 0
    ranked = join_counted(each, common, "s", "n", total).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("shared"))
    # shingles that no other set has are the rarest; they lead to nobody and use up places
    sized = ranked.join(sets.select("id", F.size("sh").alias("size")), "id")
    places = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1 - (F.col("size") - F.size("shared"))
    kept = sized.where(places > 0).select("id", "size", F.explode(F.slice("shared", F.lit(1), places.cast("int"))).alias("x")).select("id", "size", F.col("x.s").alias("s"))
    kept = materialise(kept)
    other = kept.select(F.col("id").alias("before"), F.col("size").alias("before_size"), "s")
    alike = F.least("size", "before_size") >= F.greatest("size", "before_size") * threshold - 1e-9
    return kept.join(other, "s").where((F.col("before") < F.col("id")) & alike).select("id", "before").distinct()


def greedy_rounds(pairs: DataFrame) -> DataFrame:
    """``(id)`` dropped of near pairs ``(id, before)``: each round settles whoever has no open neighbour before it."""
    live, gone = materialise(pairs), None
    while not live.isEmpty():
        kept = live.select(F.col("before").alias("id")).distinct().join(live.select("id").distinct(), "id", "left_anti")
        kept = materialise(kept)
        dropped = materialise(live.join(kept.select(F.col("id").alias("before")), "before", "left_semi").select("id").distinct())
        gone = dropped if gone is None else gone.unionByName(dropped)
        live = live.join(dropped, "id", "left_anti").join(dropped.select(F.col("id").alias("before")), "before", "left_anti")
        live = materialise(live.join(kept.select(F.col("id").alias("before")), "before", "left_anti").select("id", "before"))
    return pairs.select("id").limit(0) if gone is None else gone


def first_wins(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``(id)`` of the sets near a kept one of smaller id; ``sets`` is read often and should be a table."""
    live, gone = materialise(_bands(sets, ROWS_WITHIN)), []
    for _ in range(STARS):
        buckets = materialise(live.groupBy("key").agg(F.min("id").alias("before"), F.count("*").alias("n")).where("n > 1"))
        total = buckets.agg(F.sum("n")).first()[0]
        if not total:
            break
        waiting = materialise(join_counted(live, buckets, "key", "n", total).where(F.col("id") != F.col("before")).select("id", "before", "key"))
        # first in every bucket: everybody who might have been near and before is settled
        kept = materialise(buckets.select(F.col("before").alias("id")).distinct().join(waiting.select("id").distinct(), "id", "left_anti"))
        stars = waiting.select("id", "before").distinct().join(kept.select(F.col("id").alias("before")), "before", "left_semi")
        dropped = materialise(_verified(stars, sets, threshold).select("id").distinct())
        gone.append(dropped)
        # who shares no bucket any more is kept as well
        shared = waiting.select("id", "key").unionByName(buckets.select(F.col("before").alias("id"), "key"))
        live = materialise(shared.join(kept.unionByName(dropped), "id", "left_anti"))
    else:
        still = materialise(sets.join(live.select("id").distinct(), "id", "left_semi"))
        gone.append(greedy_rounds(_verified(rare_pairs(still, threshold), still, threshold)))
    out = sets.select("id").limit(0)
    for each in gone:
        out = out.unionByName(each)
    return out


def corpus_reasons(docs: DataFrame, bench: DataFrame, ids, strict: Column, near_item: float = 0.3, near_doc: float = 0.8, width: int = SHINGLE) -> DataFrame:
    """One ``reason`` for each document, the first that holds: quality, leak_exact, leak_near, near_dup, else kept.

    ``ids`` maps a text column to its identifiers, ``strict`` tells the documents whose
    source is not allowed to share one with the benchmark.  Copies of a text count as
    near duplicates of its first document.
    """
    rows = docs.select("doc_id", "source", "text", F.coalesce(strict, F.lit(False)).alias("strict")).withColumn("ok", quality_flag(F.col("text"))).withColumn("h", F.sha1("text"))
    wanted = bench.select(F.explode(ids(F.col("text"))).alias("x")).distinct()
    exact = rows.where("ok AND strict").select("doc_id", F.explode(ids(F.col("text"))).alias("x")).join(F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted, "x", "left_semi").select("doc_id").distinct()
    marks = materialise(rows.select("doc_id", "source", "ok", "h").join(exact.withColumn("leak", F.lit(True)), "doc_id", "left"))
    clean = marks.where(F.col("ok") & F.col("leak").isNull())
    firsts = materialise(clean.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    sets = materialise(shingle_sets(docs.join(firsts.select(F.col("first").alias("doc_id")), "doc_id", "left_semi"), "doc_id", width=width))
    items = materialise(shingle_sets(bench, "item_id", width=width))
    leaks = materialise(near_items(sets, items, near_item))
    near = first_wins(materialise(sets.join(leaks, "id", "left_anti")), near_doc)
    told = leaks.withColumn("told", F.lit("leak_near")).unionByName(near.withColumn("told", F.lit("near_dup"))).withColumnRenamed("id", "first")
    texts = materialise(firsts.join(told, "first", "left").select("h", "first", "n", F.coalesce("told", F.lit("kept")).alias("told")))
    settled = join_counted(clean.select("doc_id", "source", "h"), texts, "h", "n", texts.agg(F.sum("n")).first()[0] or 0)
    late = F.when((F.col("told") == "kept") & (F.col("doc_id") != F.col("first")), "near_dup").otherwise(F.col("told"))
    early = marks.where(~F.col("ok") | F.col("leak").isNotNull()).select("doc_id", "source", F.when(F.col("ok"), "leak_exact").otherwise("quality").alias("reason"))
    return early.unionByName(settled.select("doc_id", "source", late.alias("reason")))
