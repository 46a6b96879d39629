"""BLEU-4 and ROUGE F scores of predictions, per row and averaged."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("bleu_4", "rouge_1", "rouge_2", "rouge_l")


def _grams(items, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def bleu4(predicted: str, label: str) -> float:
    """Character BLEU-4 with brevity penalty; an order without a hit counts as 1 / (2**k * its n-grams), k counting such orders."""
    logs, empty = [], 0
    for n in range(1, 5):
        mine, theirs = _grams(predicted, n), _grams(label, n)
        hits, total = sum(min(c, theirs[g]) for g, c in mine.items()), max(1, sum(mine.values()))
        if n == 1 and not hits:
            return 0.0
        if not hits:
            empty += 1
        logs.append(math.log(hits / total if hits else 1 / (2**empty * total)))
    short = min(0.0, 1 - len(label) / len(predicted))
    return math.exp(short + sum(logs) / 4)


def rouge(predicted: list[str], label: list[str]) -> tuple[float, float, float]:
    """F scores over distinct words, distinct word pairs and the longest common subsequence."""

    def f(hits: int, a: int, b: int) -> float:
        return 2 * hits / (a + b) if hits else 0.0

    out = []
    for n in (1, 2):
        a, b = set(_grams(predicted, n)), set(_grams(label, n))
        out.append(f(len(a & b), len(a), len(b)))
    last = [0] * (len(label) + 1)
    for w in predicted:
        now = [0]
        for j, v in enumerate(label, 1):
            now.append(last[j - 1] + 1 if w == v else max(last[j], now[-1]))
        last = now
    out.append(f(last[-1], len(predicted), len(label)))
    return tuple(out)


def _scores(predicted: pd.Series, label: pd.Series) -> pd.DataFrame:
    rows = []
    for p, g in zip(predicted.fillna(""), label.fillna("")):
        rows.append([round(100 * x, 4) for x in (bleu4(p, g) if p and g else 0.0, *rouge(p.split(), g.split()))])
    return pd.DataFrame(rows, columns=list(METRICS))


def text_similarity(predicted: Column, label: Column) -> Column:
    """Struct of the four scores in percent, rounded to four places; empty texts score 0."""
    return F.pandas_udf(_scores, ", ".join(f"{m} double" for m in METRICS))(predicted, label)


def mean_similarity(df: DataFrame, predicted: str, label: str, *groups: str) -> DataFrame:
    """Mean scores, by group if there are any: rows are scored where they lie, and partial means are combined."""
    scored = df.select(*groups, text_similarity(F.col(predicted), F.col(label)).alias("s"))
    return scored.groupBy(*groups).agg(*[F.avg(F.col("s")[m]).alias(m) for m in METRICS], F.count("*").alias("n"))
