"""Names with aliases: search in texts, equality through alias and relation graphs, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.operators.graph import components
from kilnspark.sources.workspace import materialise


def _name(c: Column) -> Column:
    return F.lower(F.trim(c))


def alias_edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct lower-cased pairs, both ways are one."""
    return pairs.select(_name(F.col(a)).alias("a"), _name(F.col(b)).alias("b")).where("a is not null and b is not null").distinct()


def alias_keys(edges: DataFrame) -> DataFrame:
    """All names of the graph."""
    return edges.select(F.col("a").alias("name")).union(edges.select(F.col("b").alias("name"))).distinct()


#: Names up to which they are broadcast to the texts' words (some 50 bytes each).
BROADCAST_NAMES = 200_000
_WORDS = "[a-z0-9]+"


def _grams(words: Column, lengths: list[int]) -> Column:
    """All runs of words of these lengths, joined by a space, each once."""

    def of(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of, lengths)))


def resolve(texts: DataFrame, key: str, text: str, names: DataFrame, least: int = 3) -> DataFrame:
    """``(key, actor)``: the text itself if it is a name, else the longest name in it as a whole word (then the earliest), else the text.

    Names under ``least`` characters are not searched for.  A name that stands in a text as a whole
    word has its ASCII words there in a row, so texts meet names by runs of as many words as
    names have; names without such a word meet them by their first sign.  Then the name itself is looked for.
    """
    wanted = names.where(F.length("name") >= least).withColumn("w", F.regexp_extract_all("name", F.lit(_WORDS), F.lit(0))).select("name", F.size("w").alias("n"), F.when(F.size("w") > 0, F.array_join("w", " ")).otherwise(F.concat(F.lit("\u0000"), F.substring("name", 1, 1))).alias("gram"))
    wanted = materialise(wanted)
    sizes = wanted.groupBy("n").agg(F.count("*").alias("c")).collect()  # as many rows as the longest name has words
    lengths = sorted(r.n for r in sizes if r.n)
    side = F.broadcast(wanted) if sum(r.c for r in sizes) <= BROADCAST_NAMES else wanted
    rows = texts.select(key, F.coalesce(_name(F.col(text)), F.lit("")).alias("t"))
    split = rows.select(key, F.regexp_extract_all("t", F.lit(_WORDS), F.lit(0)).alias("w"), F.array_distinct(F.regexp_extract_all("t", F.lit("(?s)[^a-z0-9\\s]"), F.lit(0))).alias("signs"))
    parts = [_grams(F.col("w"), lengths)] if lengths else []
    if any(r.n == 0 for r in sizes):
        parts.append(F.transform("signs", lambda c: F.concat(F.lit("\u0000"), c)))
    grams = F.concat(*parts) if parts else F.array().cast("array<string>")
    met = split.select(key, F.explode(grams).alias("gram")).join(side, "gram").select(key, "name").distinct()
    hits = met.join(rows, key).where(_whole(F.col("t"), F.col("name")))
    best = hits.groupBy(key).agg(F.min(F.struct((-F.length("name")).alias("n"), F.expr("locate(name, t)").alias("at"), "name")).alias("x")).select(key, F.col("x.name").alias("found"))
    whole = rows.join(names.select(F.col("name").alias("t"), F.lit(True).alias("is_name")), "t", "left").join(best, key, "left")
    return whole.select(key, F.when(F.col("is_name"), F.col("t")).otherwise(F.coalesce("found", "t")).alias("actor"))


def _label(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias(column), F.col("component").alias(f"{column}_c")), column, "left")


def connection(pairs: DataFrame, a: str, b: str, aliases: DataFrame, related: DataFrame, legacy: bool = False) -> DataFrame:
    """``pairs`` with ``connection``: C by aliases, P by aliases and relations, else I.

    Equal names are C.  In the legacy form they are that only with an alias
    that leads back, and P only with a relation that does.
    """
    out = pairs
    for flag, edges in (("_alias", aliases), ("_any", aliases.union(related))):
        out = _label(_label(out, components(edges), a), components(edges), b)
        joined = F.col(f"{a}_c") == F.col(f"{b}_c")
        if not legacy:
            joined = joined | (F.col(a) == F.col(b))
        out = out.withColumn(flag, F.coalesce(joined, F.lit(False))).drop(f"{a}_c", f"{b}_c")
    verdict = F.when(F.coalesce(F.col(b), F.lit("")) == "", "I").when(F.col("_alias"), "C").when(F.col("_any"), "P").otherwise("I")
    return out.withColumn("connection", verdict).drop("_alias", "_any")


def actor_scores(connection_: Column) -> dict[str, Column]:
    """correct, plausible and combined of a connection."""
    c = connection_
    return {"correct": (c == "C").cast("int"), "plausible": c.isin("C", "P").cast("int"), "combined": F.when(c == "C", 1.0).when(c == "P", 0.5).otherwise(0.0)}


def _whole(text: Column, name: Column) -> Column:
    quoted = F.regexp_replace(name, r"([\\.\[\]{}()*+\-?^$|/])", r"\\$1")
    return F.regexp(text, F.concat(F.lit("(?:^|[^a-z0-9])"), quoted, F.lit("(?:$|[^a-z0-9])")))


def canonical_scores(rows: DataFrame, key: str, pred: str, answer: str, code: str, aliases: DataFrame) -> DataFrame:
    """``(key, correct, plausible, combined)``: strict by the whole-word name or code, else plausible by an alias of it."""
    base = rows.select(key, F.coalesce(_name(F.col(pred)), F.lit("")).alias("p"), F.coalesce(_name(F.col(answer)), F.lit("")).alias("g"), _name(F.col(code)).alias("c"))
    given = (F.col("p") != "") & (F.col("g") != "")
    strict = given & (_whole(F.col("p"), F.col("g")) | F.coalesce((F.col("c") != "") & _whole(F.col("p"), F.col("c")), F.lit(False)))
    found = resolve(base, key, "p", alias_keys(aliases))
    labels = components(aliases)
    near = _label(_label(base.withColumn("strict", strict).join(found, key), labels, "g"), labels, "actor")
    plausible = F.col("strict") | (given & F.coalesce((F.col("g_c") == F.col("actor_c")) | (F.col("g") == F.col("actor")), F.lit(False)))
    return near.select(key, F.col("strict").cast("int").alias("correct"), plausible.cast("int").alias("plausible"), F.when(F.col("strict"), 1.0).when(plausible, 0.5).otherwise(0.0).alias("combined"))


def weakness_accuracy(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Percentage of right ids among the predictions that are ids; one row."""
    p, g = F.upper(pred), F.upper(gold)
    valid = F.count_if(p.startswith("CWE-"))
    return df.agg(F.when(valid > 0, 100.0 * F.count_if(p == g) / valid).otherwise(0.0).alias("accuracy"), valid.alias("valid"))


def actor_accuracy(df: DataFrame, connection_: str) -> DataFrame:
    """Percentages of correct, and of correct or plausible predictions; one row."""
    c = F.col(connection_)
    return df.agg((100.0 * F.count_if(c == "C") / F.count("*")).alias("correct"), (100.0 * F.count_if(c.isin("C", "P")) / F.count("*")).alias("plausible"))
