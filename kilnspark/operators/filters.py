"""Row filters and classifications as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of a missing property.
NULL_SPELLINGS = ("", "N/A")


def recent(date: Column, since: str) -> Column:
    """Keep rows without a date; others from ``since`` on (ISO dates)."""
    return (F.coalesce(date, F.lit("")) == "") | (F.substring(date, 1, 10) >= since)


def present(value: Column) -> Column:
    """Neither null nor a spelling of null."""
    return value.isNotNull() & ~value.isin(*NULL_SPELLINGS)


def compare(value: Column, op: str, other) -> Column:
    """Scalar subscript test; ``~`` is a case-insensitive substring test."""
    other = other if isinstance(other, Column) else F.lit(other)
    if op == "~":
        return F.contains(F.lower(value), F.lower(other))
    tests = {"=": value == other, "!=": value != other, "<": value < other, "<=": value <= other, ">": value > other, ">=": value >= other}
    return tests[op]


def any_of(values: Column, op: str, other: str) -> Column:
    """List subscript ``?``: for ``!=`` the value is in no element."""
    if op == "=":
        return F.array_contains(values, other)
    if op == "!=":
        return ~F.array_contains(values, other)
    return F.exists(values, lambda x: compare(x, op, other))


def all_of(values: Column, op: str, other: str) -> Column:
    """List subscript ``*``: for ``!=`` no element equals."""
    return F.forall(values, lambda x: compare(x, op, other))


def element(values: Column, n: int) -> Column:
    """Element ``n`` from 0, or ``N/A`` beyond the end."""
    return F.coalesce(F.get(values, F.lit(n)), F.lit("N/A"))


def tags_all(tags: Column, allowed: list[str]) -> Column:
    """Every tag of the row is in the list (a subset test)."""
    return F.forall(tags, lambda t: t.isin(*allowed))


def tags_any(tags: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted]))


def eligible(prompt: Column, output: Column, least: int) -> Column:
    return (F.coalesce(prompt, F.lit("")) != "") & (F.coalesce(output, F.lit("")) != "") & (F.length(output) >= least)


def min_words(text: Column, least: int) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) >= least


def in_window(ts: Column, start: str, end: str) -> Column:
    """Inclusive window in UTC; an unparsable time is outside."""
    return F.coalesce(ts.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")), F.lit(False))


def modified_window(dates: list[Column], after: str | None, before: str | None, apply_to: str = "all") -> Column:
    """Date window over several nodes: any or all of them must lie in it."""
    tests = []
    for d in dates:
        test = F.lit(True)
        if after:
            test = test & (d >= F.lit(after).cast("timestamp_ntz"))
        if before:
            test = test & (d <= F.lit(before).cast("timestamp_ntz"))
        tests.append(F.coalesce(test, F.lit(False)))
    out = tests[0]
    for t in tests[1:]:
        out = (out | t) if apply_to == "any" else (out & t)
    return out


#: Prefixes of responses that stand for an error.
ERROR_PREFIXES = ("Error:", "Error generating response")


def is_error(response: Column) -> Column:
    text = F.coalesce(response, F.lit(""))
    return (text == "Error") | text.startswith(ERROR_PREFIXES[0]) | text.startswith(ERROR_PREFIXES[1])


def needs_refetch(response: Column) -> Column:
    text = F.trim(F.coalesce(response, F.lit("")))
    return (text == "") | (F.lower(text) == "nan") | is_error(response)


def wildcard(value: Column, pattern: Column) -> Column:
    """``X.*`` matches what begins with ``X.``; any other pattern is equality."""
    return F.when(pattern.endswith(".*"), value.startswith(F.substring(pattern, F.lit(1), F.length(pattern) - 1))).otherwise(value == pattern)


def first_rule(value: Column, rules: list[tuple[str, str]], other: str) -> Column:
    """Label of the first rule whose pattern is found."""
    out = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(value.rlike(pattern), label).otherwise(out)
    return F.coalesce(out, F.lit(other))


#: License tags by verdict.
LICENSES = {"allowed": ["cc0", "mit", "apache-2.0", "public-domain"], "allowed-nc": ["cc-by-nc-4.0"], "denied-nc": ["cc-by-nc-nd-4.0"], "denied": ["proprietary", "gpl-3.0"]}


def license_verdict(tag: Column, table: dict[str, list[str]] = LICENSES) -> Column:
    out = F.lit("unknown")
    for verdict, tags in table.items():
        out = F.when(tag.isin(*tags), verdict).otherwise(out)
    return out


def valid_example(prompts: Column, responses: Column, stage: str) -> Column:
    """Odd number of prompt turns and as many responses as the stage asks for."""
    odd = F.size(prompts) % 2 == 1
    return {"sft": odd & (F.size(responses) == 1), "pairwise": odd & (F.size(responses) >= 2), "kto": odd & (F.size(responses) >= 2), "unsupervised": odd}[stage]


def keyword_mask(words: Column, categories: list[list[str]]) -> Column:
    """Bit mask of the categories of which every keyword begins some word."""
    out = F.lit(0)
    for bit, keys in enumerate(categories):
        test = F.lit(True)
        for k in keys:
            test = test & F.exists(words, _begins(k))
        out = out + F.when(test, 1 << bit).otherwise(0)
    return out


def _begins(prefix: str):
    return lambda w: w.startswith(prefix)


def exact_id_leak(docs: DataFrame, bench: DataFrame, ids) -> DataFrame:
    """Documents that share an identifier with a benchmark item; ``ids`` maps a text column to an array."""
    wanted = bench.select(F.explode(ids(F.col("text"))).alias("id")).distinct()
    return docs.select("doc_id", F.explode(ids(F.col("text"))).alias("id")).join(wanted, "id", "left_semi").select("doc_id").distinct()
