"""Corpus curation: quality filter, n-gram decontamination, exact dedup, drop counters.

Every function takes and returns DataFrames; no rows are collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.functions.text import ascii_ratio, word_tokens
from kilnspark.sources.workspace import materialise


def quality_flag(text: Column, lo: int = 100, hi: int = 200_000, ascii_min: float = 0.85, words_min: int = 15) -> Column:
    """Length bounds, share of ASCII characters and number of alphabetic words."""
    n = F.length(text)
    return F.coalesce((n >= lo) & (n <= hi) & (ascii_ratio(text) >= ascii_min) & (F.size(F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0))) >= words_min), F.lit(False))


def exact_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def exact_dup_ids(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Least id of each distinct text: a partial aggregate, no sort of a hot group."""
    return df.groupBy(F.sha1(text_col).alias("h")).agg(F.min(id_col).alias("first_id"), F.count("*").alias("copies"))


#: N-grams of benchmark items up to which they are broadcast (16 bytes each and their item).
BROADCAST_GRAMS = 2_000_000


def _gram_keys(tokens: Column, n: int) -> Column:
    """128 hash bits of each run of ``n`` tokens; null with fewer."""
    runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.slice(tokens, i, n))
    return F.when(F.size(tokens) >= n, F.transform(runs, lambda r: F.struct(F.xxhash64(r).alias("a"), F.xxhash64(F.lit(1), r).alias("b"))))


def ngram_hits(docs: DataFrame, bench: DataFrame, n: int) -> DataFrame:
    """Shared distinct n-grams of each (document, item).

    N-grams travel as hashes of 128 bits; those of the items are broadcast behind a
    count, so that a document's other n-grams go no further than their task.
    """
    keys = lambda df, key: df.select(key, word_tokens(F.col("text")).alias("t")).select(key, F.explode(_gram_keys(F.col("t"), n)).alias("g"))
    items = materialise(keys(bench, "item_id").distinct())
    side = F.broadcast(items) if items.count() <= BROADCAST_GRAMS else items
    # repeats go after the join: few are left there, and arrays of pairs are compared one by one
    return keys(docs, "doc_id").join(side, "g").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))


def max_hits(hits: DataFrame, top: int = 5) -> DataFrame:
    """Per document the largest overlap and the items with the most, ties by id."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("shared"), "item_id")
    best = hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top)
    return best.groupBy("doc_id").agg(F.max("shared").alias("max_shared"), F.count("*").alias("n_items"))


def drop_reasons(docs: DataFrame, bench: DataFrame, n: int = 13, drop_at: int = 50) -> DataFrame:
    """One ``reason`` for each document: quality, leak, duplicate or kept, first match wins."""
    flagged = docs.withColumn("ok", quality_flag(F.col("text")))
    good = flagged.where("ok")
    leaks = materialise(max_hits(ngram_hits(good, bench, n)).where(F.col("max_shared") >= drop_at).select("doc_id", F.lit(True).alias("leak")))
    clean = good.join(leaks, "doc_id", "left_anti")
    firsts = exact_dup_ids(clean, "text", "doc_id").select(F.col("first_id").alias("doc_id"), F.lit(True).alias("first"))
    joined = flagged.join(leaks, "doc_id", "left").join(firsts, "doc_id", "left")
    reason = F.when(~F.col("ok"), "quality").when(F.col("leak"), "leak").when(F.col("first"), "kept").otherwise("duplicate")
    return joined.select("doc_id", "source", reason.alias("reason"))
