"""Tables that change as a whole: staged writes, one pointer for each version.

A version is written in a folder of its own; only when it is complete a numbered
pointer to it is created, which fails if another writer has taken that number.
Readers take the highest complete pointer, so a write that dies half-way, or a
pointer that was cut off, leaves the version before in place.  A batch number in
the pointer keeps a batch that is delivered again from being applied twice.  The file
system must create files exclusively, as HDFS and local ones do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnspark.functions.nested import is_json

T = TypeVar("T")


class Conflict(RuntimeError):
    """Another writer has published meanwhile."""


def with_retries(action: Callable[[], T], tries: int = 3, wait: float = 1.0) -> T:
    """``action``, up to ``tries`` times, with doubled waits between; the last error is raised."""
    for k in range(tries):
        try:
            return action()
        except Exception:
            if k + 1 == tries:
                raise
            time.sleep(wait * 2**k)
    raise ValueError("at least one try")


class _Files:
    """What a table needs of the Hadoop file system under its root."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        p = self.path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def create(self, name: str, data: bytes) -> None:
        """A new file; an error if there is one."""
        out = self.fs.create(self.path(name), False)
        try:
            out.write(data)
        finally:
            out.close()

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Published:
    """A table under ``root``, Parquet unless ``kind`` is another format of Spark's."""

    def __init__(self, spark: SparkSession, root: str, kind: str = "parquet"):
        self.spark, self.root, self.kind, self.files = spark, root.rstrip("/"), kind, _Files(spark, root)

    def _pointers(self) -> list[str]:
        return [n for n in self.files.names("pointers") if n.isdigit()]

    def head(self) -> dict | None:
        """``number``, ``version`` and ``batch`` of the highest complete pointer."""
        for name in reversed(self._pointers()):
            try:
                found = json.loads(self.files.read(f"pointers/{name}"))
                return {**found, "number": int(name)}
            except ValueError:  # cut off while it was written
                continue
        return None

    def read(self, schema: str | None = None) -> DataFrame | None:
        """The current version; it stays what it is while others are published."""
        head = self.head()
        if head is None:
            return None
        reader = self.spark.read.format(self.kind)
        return (reader.schema(schema) if schema else reader).load(f"{self.root}/versions/{head['version']}")

    def publish(self, df: DataFrame, batch: int | None = None, after: dict | None = None) -> dict:
        """Write ``df`` and make it current; ``after`` is the head it was made from.  A batch that isn't new changes nothing."""
        if batch is not None and after is not None and after.get("batch") is not None and batch <= after["batch"]:
            return after
        version = uuid.uuid4().hex
        df.write.format(self.kind).save(f"{self.root}/versions/{version}")
        taken = [int(n) for n in self._pointers()]
        number = max(taken, default=0) + 1
        now = self.head()
        if (now and now["number"]) != (after and after["number"]):
            raise Conflict(f"{self.root} has moved on to {now}")
        held = batch if batch is not None else (after or {}).get("batch")
        try:
            self.files.create(f"pointers/{number:012d}", json.dumps({"version": version, "batch": held}).encode())
        except Exception as e:
            raise Conflict(f"pointer {number} of {self.root} is taken") from e
        return {"version": version, "batch": held, "number": number}

    def change(self, build: Callable[[DataFrame | None], DataFrame], batch: int | None = None, tries: int = 3, wait: float = 1.0) -> dict:
        """Publish what ``build`` makes of the current version, made anew for each try."""

        def once() -> dict:
            head = self.head()
            return self.publish(build(self.read()), batch, head) if batch is None or head is None or head.get("batch") is None or batch > head["batch"] else head

        return with_retries(once, tries, wait)

    def upsert(self, new: DataFrame, keys: list[str], batch: int | None = None, tries: int = 3, wait: float = 1.0) -> dict:
        """Rows of ``new`` replace those with their keys; columns that it lacks keep their values, rows of new keys are added."""

        def build(old: DataFrame | None) -> DataFrame:
            if old is None:
                return new
            given = [c for c in new.columns if c not in keys]
            fresh = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_v_{c}") for c in given], F.lit(True).alias("_new"))
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
            both = old.join(fresh, same, "full")
            value = lambda c: F.when(F.col("_new"), F.col(f"_v_{c}")).otherwise(F.col(c)) if c in old.columns else F.col(f"_v_{c}")
            kept = [F.col(c) for c in old.columns if c not in keys and c not in given]
            return both.select(*[F.when(F.col("_new"), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys], *kept, *[value(c).alias(c) for c in given])

        return self.change(build, batch, tries, wait)

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the last ``keep`` versions and what failed writes have left; returns how many."""
        kept = set()
        for name in reversed(self._pointers()):
            try:
                kept.add(json.loads(self.files.read(f"pointers/{name}"))["version"])
            except ValueError:
                continue
            if len(kept) == keep:
                break
        old = [v for v in self.files.names("versions") if v not in kept]
        for v in old:
            self.files.delete(f"versions/{v}")
        return len(old)


def scrub_lines(table: Published) -> int:
    """Drop lines that are no JSON from a table of text lines and publish the rest; returns how many, and leaves a clean table alone."""
    head, lines = table.head(), table.read()
    if lines is None:
        return 0
    text = F.trim(F.col("value"))
    good = lines.where((text == "") | is_json(text))
    bad = lines.count() - good.count()
    if bad:
        table.publish(good.where(text != "").select(text.alias("value")), after=head)
    return bad
