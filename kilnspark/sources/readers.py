"""Readers of knowledge sources and corpora: declared schemas, no collection."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EXTENSIONS = {"arrow": "arrow", "csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "txt": "text", "tsv": "csv"}


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A whole file as one JSON value; an array gives one row for each element."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, keep_bad: bool = False) -> DataFrame:
    """JSON lines: blank and malformed lines are skipped, or kept as ``_corrupt_record``."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows if keep_bad else rows.where("_corrupt_record is null").drop("_corrupt_record")


def read_delimited(spark: SparkSession, path: str, schema: str, comment: str | None = None, limit: int | None = None) -> DataFrame:
    """Tab-separated by ``.tsv``, else commas; quoted fields may span lines."""
    reader = spark.read.schema(schema).option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").option("multiLine", True).option("escape", '"')
    if comment:
        reader = reader.option("comment", comment)
    rows = reader.csv(path)
    return rows if limit is None else rows.limit(limit)


def read_any(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """By suffix: ``.json`` whole, ``.jsonl`` by line (``.gz`` too), ``.csv`` and ``.tsv`` delimited."""
    name = path.removesuffix(".gz")
    kind = name.rsplit(".", 1)[-1]
    if kind == "json":
        rows = read_json(spark, path, schema)
    elif kind == "jsonl":
        rows = read_jsonl(spark, path, schema)
    elif kind in ("csv", "tsv"):
        rows = read_delimited(spark, path, schema)
    else:
        raise ValueError(f"unknown file type {kind}")
    return rows if limit is None else rows.limit(limit)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def read_bundle(spark: SparkSession, path: str, object_schema: str) -> DataFrame:
    """Objects of a STIX bundle, one row each."""
    return read_json(spark, path, f"objects array<struct<{object_schema}>>").select(F.explode("objects").alias("o")).select("o.*")


def read_pages(spark: SparkSession, path: str, least: int = 400) -> DataFrame:
    """HTML files as visible text; short ones dropped."""
    from kilnspark.functions.extract import html_text

    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), html_text(F.col("value")).alias("text"))
    return pages.where(F.length("text") >= least)


def read_zip(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, member, content) of the members with a suffix, archives within archives included, unzipped on the executors.

    Members come out one batch at a time, so that an archive's size bounds nothing but itself.
    """

    def members(batches):
        import io

        import pyarrow as pa

        from kilnspark.sources.archives import walk

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["path", "member", "content"])

        for given in batches:
            for p, data in zip(given.column("path").to_pylist(), given.column("content").to_pylist(), strict=True):
                rows, size = [], 0
                for name, content in walk(io.BytesIO(data), lambda m: m.endswith(suffix)):
                    rows.append((p, name, content.decode("utf-8", "replace")))
                    size += len(content)
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(members, "path string, member string, content string")


def read_yaml_rules(spark: SparkSession, path: str) -> DataFrame:
    """Flat fields and one level of maps and lists of YAML rule files: (path, key, value) rows.

    The subset that rule files use: ``key: value``, nested ``key: value`` and ``- item``.
    """

    def parse(frames):
        import re

        import pandas as pd

        for frame in frames:
            out = []
            for p, text in zip(frame["path"], frame["value"]):
                top = ""
                for line in text.split("\n"):
                    if not line.strip() or line.lstrip().startswith("#"):
                        continue
                    m = re.match(r"^(\s*)(?:- )?([\w-]+):(?:\s+(.*))?$", line)
                    item = re.match(r"^\s*- (.*)$", line)
                    if m and not m[1] and not line.startswith("-"):
                        top = m[2]
                        if m[3]:
                            out.append((p, top, m[3].strip().strip("'\"")))
                    elif m and m[3]:
                        out.append((p, f"{top}.{m[2]}", m[3].strip().strip("'\"")))
                    elif item and top:
                        out.append((p, top, item[1].strip().strip("'\"")))
            yield pd.DataFrame(out, columns=["path", "key", "value"])

    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.yml")
    return files.select(F.input_file_name().alias("path"), "value").mapInPandas(parse, "path string, key string, value string")


@dataclass
class Dataset:
    """A named dataset: where it lies, how it is read, and what its columns are called here."""

    name: str
    path: str
    kind: str = "parquet"
    schema: str | None = None
    columns: dict[str, str] = field(default_factory=dict)
    samples: int | None = None


class Registry:
    """Datasets by name; unknown names and mixed file types are errors."""

    def __init__(self, datasets: list[Dataset]):
        self.datasets = {d.name: d for d in datasets}

    @classmethod
    def from_config(cls, config: dict[str, dict]) -> Registry:
        return cls([Dataset(n, **c) for n, c in config.items()])

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, override: str | None = None) -> tuple[Registry, list[str]]:
        """(registry, names to read) of a JSON config ``{"sources": {name: {"enabled": true, "path": ...}}}``.

        Without a comma-separated ``override`` the enabled sources are read; unknown names are an error.
        """
        text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
        sources = json.loads(text).get("sources", {})
        found = cls.from_config({n: {k: v for k, v in c.items() if k != "enabled"} for n, c in sources.items()})
        return found, found.enabled(override, [n for n, c in sources.items() if c.get("enabled", False)])

    def add(self, dataset: Dataset) -> None:
        if dataset.name in self.datasets:
            raise ValueError(f"dataset {dataset.name} exists")
        self.datasets[dataset.name] = dataset

    def save(self, spark: SparkSession, path: str) -> None:
        """The registry as a JSON manifest."""
        from kilnspark.sources.sinks import write_bytes

        write_bytes(spark, f"{path}/registry.json", json.dumps([asdict(d) for d in self.datasets.values()], indent=1).encode())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Registry:
        text = "\n".join(r["value"] for r in spark.read.text(f"{path}/registry.json", wholetext=True).collect())
        return cls([Dataset(**d) for d in json.loads(text)])

    @staticmethod
    def kind_of(spark: SparkSession, path: str) -> str:
        """The one file type under a path; several are an error."""
        names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.regexp_extract("path", r"\.([A-Za-z]+)(?:\.gz)?$", 1).alias("kind")).distinct()
        kinds = sorted(r["kind"] for r in names.limit(len(EXTENSIONS) + 1).collect() if r["kind"])
        if len(kinds) != 1 or kinds[0] not in EXTENSIONS:
            raise ValueError(f"file types under {path}: {', '.join(kinds) or 'none'}")
        return kinds[0]

    def enabled(self, names: str | None, default: list[str]) -> list[str]:
        """Names of a comma-separated override, or the defaults."""
        wanted = [n.strip() for n in names.split(",")] if names else default
        if missing := [n for n in wanted if n not in self.datasets]:
            raise KeyError(f"unknown sources: {', '.join(missing)}")
        return wanted

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        d = self.datasets[name]
        if d.kind == "auto":
            d = replace(d, kind=self.kind_of(spark, d.path))
        if d.kind not in EXTENSIONS:
            raise ValueError(f"unknown file type {d.kind}")
        if d.kind in ("csv", "tsv", "json", "jsonl") and d.schema:
            rows = read_any(spark, d.path, d.schema)
        else:
            rows = spark.read.format(EXTENSIONS[d.kind]).load(d.path)
        if d.columns:
            rows = rows.select(*[F.col(theirs).alias(ours) for ours, theirs in d.columns.items()])
        return rows if d.samples is None else rows.limit(d.samples)


def batched_map(df: DataFrame, change, schema: str, size: int = 1000) -> DataFrame:
    """``change`` over batches of ``size`` rows of a partition: a dictionary of lists to a dictionary of lists, of any length.

    Batches are whole but for the last one of a partition, however Arrow has cut the rows.
    """

    def run(frames):
        import pandas as pd

        def out(rows: list[tuple]):
            made = change({c: list(v) for c, v in zip(names, zip(*rows, strict=True), strict=True)})
            return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in made.items()})

        names, held = None, []
        for frame in frames:
            names = list(frame.columns)
            held += list(frame.itertuples(index=False, name=None))
            while len(held) >= size:
                yield out(held[:size])
                held = held[size:]
        if held:
            yield out(held)

    return df.mapInPandas(run, schema)
