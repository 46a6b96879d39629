"""Tables of named functions: parsers, converters, plug-ins and scorers that users add to."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.functions.answers import extract_answer
from kilnspark.operators import dialogue, metrics, render, samples


class Table:
    """Functions by name; a name is taken once, and unknown names say which there are."""

    def __init__(self, what: str, entries: dict[str, Callable] | None = None):
        self.what, self.entries = what, dict(entries or {})

    def register(self, name: str, function: Callable | None = None):
        """Add a function; without one, a decorator that adds."""
        if function is None:
            return lambda f: self.register(name, f)
        if name in self.entries:
            raise ValueError(f"{self.what} {name} exists")
        self.entries[name] = function
        return function

    def __call__(self, name: str, *args: Any, **more: Any) -> Any:
        if name not in self.entries:
            raise KeyError(f"no {self.what} {name}; there are {', '.join(sorted(self.entries))}")
        return self.entries[name](*args, **more)


#: Rows of a source format to documents.
PARSERS = Table("parser", {"stix": render.stix_documents, "kev": render.kev_documents})
#: Raw samples to aligned ones.
CONVERTERS = Table("converter", {"alpaca": samples.align_alpaca, "messages": samples.align_messages})
#: Raw columns to messages with loss weights.
WEIGHTED = Table("plug-in", {"alpaca": dialogue.weigh_alpaca, "sharegpt": dialogue.weigh_shared, "messages": dialogue.weigh_messages})
#: Extracted answer and gold answer to a score.
SCORERS = Table("scorer", {
    "equal": lambda pred, gold: (pred == gold).cast("double"),
    "letters": lambda pred, gold: metrics.jaccard(F.split(pred, ","), F.split(gold, ",")),
    "ids": lambda pred, gold: metrics.f1(F.split(pred, ", "), F.split(gold, ", ")),
    "severity": lambda pred, gold: 1 - F.abs(metrics.cvss31(pred) - metrics.cvss31(gold)) / 10,
})


def score_responses(df: DataFrame, tasks: dict[str, tuple[str, str]], task: str, response: str, gold: str) -> DataFrame:
    """``df`` with ``answer`` and ``score`` by each row's task; ``tasks`` maps it to its extractor and scorer.

    Rows of other tasks and answers that can't be scored have null.
    """
    answer, score = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, (extractor, _) in tasks.items():
        answer = F.when(F.col(task) == name, extract_answer(extractor, F.col(response))).otherwise(answer)
    out = df.withColumn("answer", answer)
    for name, (_, scorer) in tasks.items():
        score = F.when(F.col(task) == name, SCORERS(scorer, F.col("answer"), F.col(gold))).otherwise(score)
    return out.withColumn("score", score)


def both_right(left: DataFrame, right: DataFrame, key: str, score: str, length: str) -> DataFrame:
    """Two backends on the same rows: counts by which of them are right, and the mean difference in length."""
    a = left.select(key, (F.col(score) == 1).alias("left_right"), F.col(length).alias("n"))
    b = right.select(key, (F.col(score) == 1).alias("right_right"), F.col(length).alias("m"))
    return a.join(b, key).groupBy("left_right", "right_right").agg(F.count("*").alias("rows"), F.avg(F.col("n") - F.col("m")).alias("mean_diff"))


def apply_patch(old: DataFrame, patch: DataFrame, index: str, question: str, answer: str) -> DataFrame:
    """Rows with the patched answers and the ``outcome`` of each: missing, mismatch, bad, same or replaced.

    A patch applies where its question is the row's own; ``X`` is no answer.
    """
    p = patch.select(index, F.col(question).alias("_q"), F.col(answer).alias("_a"))
    j = old.join(p, index, "left")
    outcome = F.when(F.col("_q").isNull(), "missing").when(F.col("_q") != F.col(question), "mismatch").when(F.coalesce(F.col("_a"), F.lit("X")) == "X", "bad").when(F.col("_a") == F.col(answer), "same").otherwise("replaced")
    return j.withColumn("outcome", outcome).withColumn(answer, F.when(F.col("outcome") == "replaced", F.col("_a")).otherwise(F.col(answer))).drop("_q", "_a")


def merge_runs(old: DataFrame, new: DataFrame, key: str = "run_id", scores: str = "benchmarks") -> DataFrame:
    """Registry of runs: new fields win where they are set, and scores of earlier benchmarks stay."""
    names = [c for c in old.columns if c not in (key, scores)]
    fresh = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in (*names, scores)])
    none = F.create_map().cast(old.schema[scores].dataType)
    kept = F.map_filter(F.coalesce(scores, none), lambda k, _: ~F.coalesce(F.map_contains_key(F.coalesce(f"_new_{scores}", none), k), F.lit(False)))
    return old.join(fresh, key, "full").select(key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in names], F.map_concat(kept, F.coalesce(f"_new_{scores}", none)).alias(scores))


def stale(predictions: DataFrame, scored: DataFrame, key: str = "name", time: str = "modified") -> DataFrame:
    """Predictions to score again: without scores, or newer than them."""
    done = scored.select(key, F.col(time).alias("_scored"))
    return predictions.join(done, key, "left").where(F.col("_scored").isNull() | (F.col("_scored") < F.col(time))).drop("_scored")


def buffer_batches(df: DataFrame, order: str, tokens: str, most: int, shard: Column) -> DataFrame:
    """Batches of a token budget within shards of bounded size: column ``batch``; a batch closes where a row crosses a multiple of the budget.

    A batch number depends on the rows before it alone, so a reader resumes at any batch.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("shard").orderBy(order)
    rows = df.withColumn("shard", shard.cast("long"))
    return rows.withColumn("batch", F.floor((F.sum(tokens).over(w) - F.col(tokens)) / most))
