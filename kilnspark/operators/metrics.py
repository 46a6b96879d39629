"""Scoring functions over identifier sets, labels and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """0 for two empty sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def f1(pred: Column, gold: Column) -> Column:
    """Set F1; null without gold, 0 without a hit."""
    hit = F.size(F.array_intersect(pred, gold))
    return F.when(F.size(gold) > 0, F.when(hit > 0, 2.0 * hit / (F.size(F.array_distinct(pred)) + F.size(F.array_distinct(gold)))).otherwise(0.0))


def tiered_f1(pred: Column, strict: Column, plausible: Column) -> Column:
    """Precision over strict or plausible answers, recall over strict; plausible hits alone give 0.5."""
    good = F.size(F.array_intersect(pred, strict))
    near = F.size(F.array_intersect(pred, F.array_except(plausible, strict)))
    precision = (good + near) / F.greatest(F.size(pred), F.lit(1))
    recall = good / F.greatest(F.size(strict), F.lit(1))
    combined = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return F.when((good == 0) & (near > 0), 0.5).otherwise(combined)


def macro_f1(df: DataFrame, pred: str, gold: str, labels: list[str]) -> DataFrame:
    """Accuracy and unweighted mean F1 from confusion counts; one row."""
    aggs = [F.avg((F.col(pred) == F.col(gold)).cast("double")).alias("accuracy")]
    for k, x in enumerate(labels):
        aggs += [F.sum(((F.col(pred) == x) & (F.col(gold) == x)).cast("long")).alias(f"tp{k}"), F.sum((F.col(pred) == x).cast("long")).alias(f"p{k}"), F.sum((F.col(gold) == x).cast("long")).alias(f"g{k}")]
    each = [F.when(F.col(f"p{k}") + F.col(f"g{k}") > 0, 2.0 * F.col(f"tp{k}") / (F.col(f"p{k}") + F.col(f"g{k}"))).otherwise(0.0) for k in range(len(labels))]
    return df.agg(*aggs).select("accuracy", (sum(each[1:], each[0]) / len(labels)).alias("macro_f1"))


def matthews(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Accuracy, F1 of class 1 and Matthews correlation of 0/1 labels; one row."""
    p, g = F.col(pred) == 1, F.col(gold) == 1
    c = df.agg(*[F.sum((a & b).cast("double")).alias(n) for n, a, b in (("tp", p, g), ("fp", p, ~g), ("fn", ~p, g), ("tn", ~p, ~g))])
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    root = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.select(((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"), (2 * tp / (2 * tp + fp + fn)).alias("f1"), F.when(root > 0, (tp * tn - fp * fn) / root).otherwise(0.0).alias("mcc"))


def running_count(counts: DataFrame, order: str, count: str, name: str) -> DataFrame:
    """``counts`` with the sum of ``count`` up to each row in the order of a column without repeats."""
    from pyspark.sql import Window

    from kilnspark.sources.workspace import materialise

    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(counts.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()))
    sums = rows.groupBy("_part").agg(F.sum(count).alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = sums.select("_part", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    local = F.sum(count).over(Window.partitionBy("_part").orderBy(order))
    return rows.withColumn("_local", local).join(F.broadcast(offsets), "_part").select(*counts.columns, (F.col("_local") + F.col("_before")).alias(name))


def spearman(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Rank and product-moment correlation of two columns; one row, null if either has no spread."""
    both = df.where(F.col(pred).isNotNull() & F.col(gold).isNotNull()).select(F.col(pred).cast("double").alias("p"), F.col(gold).cast("double").alias("g"))
    pairs = both.groupBy("p", "g").agg(F.count("*").cast("long").alias("n"))
    ranked = pairs.join(_ranks_of(pairs, "p", "rp"), "p").join(_ranks_of(pairs, "g", "rg"), "g")

    def corr(x: str, y: str) -> Column:
        n, sx, sy = F.sum("n"), F.sum(F.col("n") * F.col(x)), F.sum(F.col("n") * F.col(y))
        sxy, sxx, syy = (F.sum(F.col("n") * F.col(a) * F.col(b)) for a, b in ((x, y), (x, x), (y, y)))
        spread = (n * sxx - sx * sx) * (n * syy - sy * sy)
        return F.when(spread > 0, (n * sxy - sx * sy) / F.sqrt(spread))

    return ranked.agg(corr("rp", "rg").alias("spearman"), corr("p", "g").alias("pearson"))


def _ranks_of(pairs: DataFrame, value: str, name: str) -> DataFrame:
    counts = pairs.groupBy(value).agg(F.sum("n").alias("_n"))
    return running_count(counts, value, "_n", "_upto").select(value, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name))


def question_scores(df: DataFrame, question: str, pred: str, gold: str) -> DataFrame:
    """Answers in groups of a question, labels 0 and 1; one row.

    ``f1_m``: mean over questions of the F1 of class 1 (0 where neither has it);
    ``exact_match``: share of questions whose answers are all right; ``f1_a``: F1 over all answers.
    """
    p, g = F.col(pred) == 1, F.col(gold) == 1
    each = df.groupBy(question).agg(F.sum((p & g).cast("long")).alias("tp"), F.sum(p.cast("long")).alias("p"), F.sum(g.cast("long")).alias("g"), F.min((F.col(pred) == F.col(gold)).cast("int")).alias("right"))
    f = lambda tp, p, g: F.when(p + g > 0, 2.0 * tp / (p + g)).otherwise(0.0)
    return each.agg(F.avg(F.col("right").cast("double")).alias("exact_match"), F.avg(f(F.col("tp"), F.col("p"), F.col("g"))).alias("f1_m"), f(F.sum("tp"), F.sum("p"), F.sum("g")).alias("f1_a"))


def category_accuracy(df: DataFrame, subject: str, pred: str, gold: str, categories: DataFrame) -> DataFrame:
    """``(category, accuracy, n)`` in percent with two decimals: subjects by their category, and all of them as ``Average``.

    ``categories`` has (subject, category); a prediction is right if it is the label itself, none is wrong.
    """
    right = F.coalesce(F.col(pred) == F.col(gold), F.lit(False)).cast("int")
    by_subject = df.groupBy(F.col(subject).alias("subject")).agg(F.sum(right).alias("right"), F.count("*").alias("n"))
    known = by_subject.join(categories, "subject").select(F.explode(F.array("category", F.lit("Average"))).alias("category"), "right", "n")
    return known.groupBy("category").agg(F.round(100.0 * F.sum("right") / F.sum("n"), 2).alias("accuracy"), F.sum("n").alias("n"))


def slice_table(slices: DataFrame, kinds: list[str]) -> DataFrame:
    """``(slice, place, name, n, avg_score, strict_pct, parse_errors)``: slices of each kind by falling size, then by name.

    ``slices`` has a row for each value of each of ``kinds``, the other kinds being null; it is as small as their values are few.
    """
    from pyspark.sql import Window

    kind = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in kinds])
    rows = slices.select(kind.alias("slice"), F.coalesce(*[F.col(k).cast("string") for k in kinds]).alias("name"), (F.col("answered") + F.col("parse_errors")).alias("n"), "avg_score", "strict_pct", "parse_errors")
    place = F.row_number().over(Window.partitionBy("slice").orderBy(F.desc("n"), "name"))
    return rows.select("slice", place.alias("place"), "name", "n", "avg_score", "strict_pct", "parse_errors")


def normal_answer(text: Column) -> Column:
    """Lower case without ASCII punctuation and articles, single spaces."""
    bare = F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?U)\b(?:a|an|the)\b", " "), r"\s+", " "))


def _bag_f1(pred: Column, gold: Column) -> Column:
    """F1 of two bags of words: each word counts as often as both have it."""
    words = F.array_distinct(pred)
    count = lambda bag, w: F.size(F.filter(bag, lambda x: x == w))
    same = F.aggregate(words, F.lit(0), lambda n, w: n + F.least(count(pred, w), count(gold, w)))
    return F.when(same > 0, 2.0 * same / (F.size(pred) + F.size(gold))).otherwise(0.0)


def best_answer(pred: Column, golds: Column) -> tuple[Column, Column]:
    """(exact match, F1) of a text against the best of several answers; 0 without any."""
    said, words = normal_answer(pred), F.filter(F.split(normal_answer(pred), " "), lambda w: w != "")
    exact = F.exists(golds, lambda g: normal_answer(g) == said)
    scores = F.transform(golds, lambda g: _bag_f1(words, F.filter(F.split(normal_answer(g), " "), lambda w: w != "")))
    return F.coalesce(exact, F.lit(False)).cast("double"), F.coalesce(F.array_max(scores), F.lit(0.0))


def tier_cost(tokens: Column, tiers: list[tuple[int, int | None, float]]) -> Column:
    """Price of a request: the first tier whose bounds hold the count, per million; 0 without one."""
    out = F.lit(0.0)
    for low, high, rate in reversed(tiers):
        inside = (tokens >= low) & (F.lit(True) if high is None else tokens <= high)
        out = F.when(inside, tokens * rate / 1e6).otherwise(out)
    return out


#: Weights of the public CVSS v3.1 formula.
CVSS = {
    "AV": {"N": 0.85, "A": 0.62, "L": 0.55, "P": 0.2},
    "AC": {"L": 0.77, "H": 0.44},
    "UI": {"N": 0.85, "R": 0.62},
    "C": {"H": 0.56, "L": 0.22, "N": 0.0},
    "I": {"H": 0.56, "L": 0.22, "N": 0.0},
    "A": {"H": 0.56, "L": 0.22, "N": 0.0},
}
CVSS_PR = {"U": {"N": 0.85, "L": 0.62, "H": 0.27}, "C": {"N": 0.85, "L": 0.68, "H": 0.5}}


def cvss31(vector: Column) -> Column:
    """Base score of a v3.x vector; null where a metric is missing."""

    def metric(name: str) -> Column:
        return F.regexp_extract(vector, f"/{name}:([A-Z])", 1)

    def weight(value: Column, table: dict[str, float]) -> Column:
        out = F.lit(None).cast("double")
        for k, w in table.items():
            out = F.when(value == k, w).otherwise(out)
        return out

    w = {m: weight(metric(m), t) for m, t in CVSS.items()}
    changed = metric("S") == "C"
    pr = F.when(changed, weight(metric("PR"), CVSS_PR["C"])).otherwise(weight(metric("PR"), CVSS_PR["U"]))
    iss = 1 - (1 - w["C"]) * (1 - w["I"]) * (1 - w["A"])
    impact = F.when(changed, 7.52 * (iss - 0.029) - 3.25 * F.pow(iss - 0.02, F.lit(15))).otherwise(6.42 * iss)
    ease = 8.22 * w["AV"] * w["AC"] * pr * w["UI"]
    raw = F.least(F.lit(10.0), F.when(changed, 1.08 * (impact + ease)).otherwise(impact + ease))
    scaled = F.round(raw * 100000).cast("long")
    up = F.when(scaled % 10000 == 0, scaled / 100000.0).otherwise((F.floor(scaled / 10000) + 1) / 10.0)
    return F.when(impact <= 0, 0.0).otherwise(up)


def elapsed(seconds: Column) -> Column:
    """1h02m03s, 2m03s or 3s."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def infer_lengths(source: Column, target: Column, cutoff: int) -> tuple[Column, Column]:
    """Token budget of prompt and response: the shorter side keeps what it needs."""
    half = (cutoff * target / (source + target)).cast("int")
    most = F.when(target * 2 < cutoff, F.lit(cutoff)).when(source * 2 < cutoff, cutoff - source).otherwise(half)
    new_target = F.least(most, target)
    return F.least(F.greatest(cutoff - new_target, F.lit(0)), source), new_target
