"""Sinks: JSON lines, delimited files, keyed tables, token caches, reports."""

from __future__ import annotations

import csv
import hashlib
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_corpus(df: DataFrame, path: str, text: str = "text", mode: str = "errorifexists") -> None:
    """One ``{"text": ...}`` on each line."""
    df.select(F.col(text).alias("text")).write.mode(mode).json(path)


def write_array(df: DataFrame, path: str, most: int = 100_000) -> None:
    """A JSON array in one file, for small exports only: more rows than ``most`` are an error."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows; write JSON lines")
    whole = df.select(F.to_json(F.struct(*df.columns)).alias("j")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ",\n"), F.lit("]")).alias("value"))
    whole.coalesce(1).write.text(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def scrub_jsonl(spark: SparkSession, path: str, schema: str, out: str) -> None:
    """Valid lines of a file, to another place; readers switch over when it is complete."""
    from kilnspark.sources.readers import read_jsonl

    read_jsonl(spark, path, schema).write.json(out)


def merge_keyed(old: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those with the same keys; keys compare null-safely."""
    if old is None:
        return new
    right = new.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    test = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        test = one if test is None else test & one
    return old.join(right, test, "left_anti").unionByName(new, allowMissingColumns=True)


def cached(spark: SparkSession, root: str, config: dict, build) -> DataFrame:
    """The table of a configuration: read if complete, else built and written."""
    name = hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]
    path = f"{root}/{name}"
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def report(df: DataFrame, most: int = 10_000) -> list[dict]:
    """A small result as dictionaries; larger ones are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a report")
    return [r.asDict(recursive=True) for r in rows]


def report_text(df: DataFrame, kind: str, most: int = 10_000) -> str:
    """A small result as JSON, markdown, CSV or TSV text."""
    rows, names = report(df, most), df.columns
    if kind == "json":
        return json.dumps(rows, indent=None, default=str).replace("}, {", "},\n{")
    if kind == "md":
        body = [names, ["-"] * len(names), *[[str(r[c]) for c in names] for r in rows]]
        return "".join("| " + " | ".join(x) + " |\n" for x in body)
    if kind in ("csv", "tsv"):
        out = io.StringIO()
        writer = csv.writer(out, delimiter="," if kind == "csv" else "\t", lineterminator="\n")
        writer.writerow(names)
        writer.writerows([r[c] for c in names] for r in rows)
        return out.getvalue()
    raise ValueError(f"unknown report {kind}")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file at any path that Spark's file systems know."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(data)
    finally:
        out.close()
