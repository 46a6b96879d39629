"""Members of zip archives as a data source: ``spark.read.format("archive").load(folder)``.

Rows are ``(path, member, size, content)``; the members of archives within archives
are named ``inner.zip!/member``.  A large archive is dealt over several tasks, each of
which reads the directory at its end and then its own members.  Equality and
prefix or suffix tests on ``path`` and ``member`` are pushed: archives, inner archives and
members that can't match are never opened.  Files are reached by Arrow's file systems
(``file:``, ``hdfs:``, ``s3:``); ``read_zip`` serves stores that Spark alone can open.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith

SCHEMA = "path string, member string, size long, content binary"
#: Bytes of an archive that one task reads.
TASK_BYTES = 32 << 20
#: Archives within archives; deeper ones are an error, for they may have no end.
DEEPEST = 8


def walk(data: BinaryIO, wanted=lambda member: True, enters=lambda archive: True, share: tuple[int, int] = (0, 1), before: str = "", depth: int = 0) -> Iterator[tuple[str, bytes]]:
    """(member, content) of an archive and of those within it; ``share`` (k, n) takes the k-th of n parts of the top members."""
    if depth > DEEPEST:
        raise ValueError(f"{before} lies in more than {DEEPEST} archives")
    with zipfile.ZipFile(data) as z:
        for info in sorted(z.infolist(), key=lambda i: i.filename):
            if info.is_dir() or (depth == 0 and zlib.crc32(info.filename.encode()) % share[1] != share[0]):
                continue
            name = before + info.filename
            if name.lower().endswith(".zip"):
                if enters(f"{name}!/"):
                    yield from walk(io.BytesIO(z.read(info)), wanted, enters, (0, 1), f"{name}!/", depth + 1)
            elif wanted(name):
                yield name, z.read(info)


@dataclass
class Part(InputPartition):
    path: str
    k: int
    n: int


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.tests: dict[str, list[Filter]] = {"path": [], "member": []}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in self.tests and isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith)):
                self.tests[column].append(f)
            else:
                yield f

    def _holds(self, column: str, value: str) -> bool:
        def one(f: Filter) -> bool:
            if isinstance(f, StringStartsWith):
                return value.startswith(f.value)
            if isinstance(f, StringEndsWith):
                return value.endswith(f.value)
            return value in f.value if isinstance(f, In) else value == f.value

        return all(one(f) for f in self.tests[column])

    def _may_hold(self, archive: str) -> bool:
        """Whether a member whose name begins like this can match."""

        def one(f: Filter) -> bool:
            if isinstance(f, StringEndsWith):
                return True
            if isinstance(f, StringStartsWith):
                return f.value.startswith(archive) or archive.startswith(f.value)
            return any(v.startswith(archive) for v in (f.value if isinstance(f, In) else [f.value]))

        return all(one(f) for f in self.tests["member"])

    def partitions(self) -> list[Part]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        base = self.path.split("://", 1)[0] + "://" if "://" in self.path else ""
        out = []
        for f in found:
            if f.type == fs.FileType.File and f.path.lower().endswith(".zip") and not posixpath.basename(f.path).startswith(("_", ".")) and self._holds("path", base + f.path):
                n = max(1, -(-f.size // TASK_BYTES))
                out += [Part(base + f.path, k, n) for k in range(n)]
        return out

    def read(self, partition: Part) -> Iterator[tuple]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(partition.path)
        with store.open_input_file(path) as data:
            for member, content in walk(data, lambda m: self._holds("member", m), self._may_hold, (partition.k, partition.n)):
                yield partition.path, member, len(content), content


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: Any) -> ArchiveReader:
        path = self.options.get("path")
        if not path:
            raise ValueError("an archive source needs a path")
        return ArchiveReader(path if "://" in path else f"file://{path.removeprefix('file:')}")


def register(spark: SparkSession) -> None:
    """Make the format known to a session, filters included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)
