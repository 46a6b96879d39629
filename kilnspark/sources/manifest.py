"""Template manifests: blocks of text or JSON rows as a table, and the row limit of a template.

Each file is parsed where it is read.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "shortname string, text string, summary string, schema string, sample string, shuffle string, source string, count_limit int, per_primary_grouping boolean, source_line int"
#: Lines that say something about a template.
DIRECTIVES = ("Summary", "Schema", "Sample", "Shuffle", "Source", "Count", "Per_primary_grouping")
_HEAD = re.compile(r"^(\S+)\s+Instruction:\s*(.+)$")


def _count(value) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def _row(name: str, parts: dict[str, str], said: dict[str, str], line: int) -> tuple:
    text = "\n\n".join(f"{k}: {parts[k]}" for k in ("Instruction", "Question", "Answer")) + "".join(f"\n\n{x}" for x in parts.get("force", "").split("\n") if x)
    get = lambda k: said.get(k) or None
    return (name, text, get("Summary"), get("Schema"), get("Sample"), get("Shuffle"), get("Source"), _count(said.get("Count")), (said.get("Per_primary_grouping") or "").lower() in ("true", "yes", "1"), line)


def parse_manifest(text: str) -> list[tuple]:
    """Blocks of ``ID Instruction:``, ``Question:`` and ``Answer:`` with conditions and directives; blocks without a question or an answer are skipped."""
    rows, name, parts, said, line, field = [], None, {}, {}, 0, None

    def close() -> None:
        for k in ("Question", "Answer"):
            parts[k] = parts.get(k, "").strip()
        if name and parts["Question"] and parts["Answer"]:
            rows.append(_row(name, parts, said, line))

    for number, raw in enumerate(text.split("\n"), 1):
        x = raw.strip()
        if m := _HEAD.match(x):
            close()
            name, parts, said, line, field = m[1], {"Instruction": m[2].strip()}, {}, number, None
        elif name is None:
            continue
        elif x.startswith("{force"):
            parts["force"] = f"{parts.get('force', '')}\n{x}"
            field = None
        elif (key := x.partition(": ")[0]) in DIRECTIVES:
            said[key], field = x.partition(": ")[2].strip(), None
        elif x.startswith(("Question:", "Answer:")):
            field = x.partition(":")[0]
            parts[field] = x.partition(":")[2].strip()
        elif field:
            parts[field] += f"\n{x}"
    close()
    return rows


def parse_json(text: str) -> list[tuple]:
    """Rows of (id, instruction, question, answer) and optional directives; incomplete ones are skipped."""
    entries = json.loads(text)
    if not isinstance(entries, list):
        raise ValueError("a JSON manifest is a list")
    out = []
    for n, e in enumerate(entries, 1):
        if all(str(e.get(k) or "").strip() for k in ("id", "instruction", "question", "answer")):
            said = {k.capitalize(): str(e[k]).strip() for k in ("summary", "schema", "source", "sample", "shuffle") if e.get(k)} | ({"Count": e["count_limit"]} if e.get("count_limit") is not None else {})
            out.append(_row(str(e["id"]).strip(), {k.capitalize(): str(e[k]).strip() for k in ("instruction", "question", "answer")}, said, n))
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Text or JSON manifests as a table of templates; each file is parsed in the task that reads it."""

    def parse(frames):
        import pandas as pd

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for frame in frames:
            for file, text in zip(frame["file"], frame["value"], strict=True):
                rows = parse_json(text) if file.endswith(".json") else parse_manifest(text)
                yield pd.DataFrame(rows, columns=names).astype({"count_limit": "Int64", "source_line": "Int64"})

    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return files.mapInPandas(parse, SCHEMA)


def limits(template: Column, override: int | None = None, asked: int = -1, default: int = 10) -> Column:
    """``resolve_limit`` for a column of templates' own counts."""
    given = F.lit(override) if override is not None else F.coalesce(template, F.lit(asked if asked >= 0 else default))
    return F.least(given, F.lit(asked)) if asked >= 0 else given


def resolve_limit(template: int | None, override: int | None = None, asked: int = -1, default: int = 10) -> int:
    """Rows of a template: the override, else its own count, else what was asked for, else the default; what was asked for is a ceiling too."""
    limit = override if override is not None else template if template is not None else asked if asked >= 0 else default
    return min(limit, asked) if asked >= 0 else limit
