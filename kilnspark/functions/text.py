"""Text functions as Column expressions: all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_ratio(text: Column) -> Column:
    """Share of ASCII characters."""
    return F.length(F.regexp_replace(text, r"[^\x00-\x7F]", "")) / F.length(text)


def word_tokens(text: Column) -> Column:
    """Lower-cased ASCII alphanumeric runs."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def shingle_tokens(text: Column) -> Column:
    """Lower-cased runs that keep ``_``, ``.`` and ``-`` inside tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_.-]+"), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens joined by a space; empty with fewer tokens."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def squash(text: Column) -> Column:
    """White space runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))
