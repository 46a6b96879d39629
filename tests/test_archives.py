"""Archives as a data source: parts, pushed filters, archives within archives."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringEndsWith, StringStartsWith

from kilnspark.sources import archives as A
from kilnspark.sources.readers import read_zip


def packed(members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, content in members.items():
            z.writestr(name, packed(content) if isinstance(content, dict) else content)
    return data.getvalue()


CONTENT = {
    "a.zip": {f"d/{k}.json": f'{{"n": {k}}}' for k in range(30)} | {"d/x.txt": "text", "in.zip": {"y.json": "{}", "deep.ZIP": {"z.txt": "é"}}},
    "sub/b.zip": {"only.txt": "b", "empty.zip": {}},
    "c.txt": b"no archive",
}


@pytest.fixture
def folder(tmp_path):
    for name, content in CONTENT.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(packed(content) if isinstance(content, dict) else content)
    return str(tmp_path)


def flat(members, before=""):
    for name, content in members.items():
        if isinstance(content, dict):
            yield from flat(content, f"{before}{name}!/")
        else:
            yield before + name, content.encode()


EVERY = {(f, m): c for f in ("a.zip", "sub/b.zip") for m, c in flat(CONTENT[f])}


def found(df, folder):
    return {(r.path.removeprefix(f"file://{folder}/"), r.member): bytes(r.content) for r in df.collect()}


def test_all_members_in_any_number_of_parts(spark, folder, monkeypatch):
    A.register(spark)
    df = spark.read.format("archive").load(folder)
    assert found(df, folder) == EVERY and df.agg(F.sum("size")).first()[0] == sum(map(len, EVERY.values()))
    monkeypatch.setattr(A, "TASK_BYTES", 500)
    reader = A.ArchiveReader(f"file://{folder}")
    assert len(reader.partitions()) > 4
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == len(EVERY) and {(p.removeprefix(f"file://{folder}/"), m): c for p, m, _, c in rows} == EVERY


def test_pushed_filters_prune(spark, folder):
    A.register(spark)
    df = spark.read.format("archive").load(folder)
    for test, keep in (
        (F.col("member").endswith(".json"), lambda f, m: m.endswith(".json")),
        (F.col("member").startswith("in.zip!/deep"), lambda f, m: m.startswith("in.zip!/deep")),
        (F.col("member").isin("only.txt", "d/3.json"), lambda f, m: m in ("only.txt", "d/3.json")),
        ((F.col("path") == f"file://{folder}/sub/b.zip") & (F.col("size") > 0), lambda f, m: f == "sub/b.zip"),
        (F.col("size") == 4, lambda f, m: len(EVERY[f, m]) == 4),
    ):
        assert found(df.where(test), folder) == {k: v for k, v in EVERY.items() if keep(*k)}
    reader = A.ArchiveReader(f"file://{folder}")
    assert list(reader.pushFilters([EqualTo(("path",), f"file://{folder}/sub/b.zip"), EqualTo(("size",), 3)])) == [EqualTo(("size",), 3)]
    assert [p.path for p in reader.partitions()] == [f"file://{folder}/sub/b.zip"]
    opened = []
    for tests, inner in (([StringStartsWith(("member",), "d/")], []), ([In(("member",), ("in.zip!/y.json",))], ["in.zip!/"]), ([StringEndsWith(("member",), ".txt")], ["in.zip!/", "in.zip!/deep.ZIP!/"])):
        reader = A.ArchiveReader(f"file://{folder}")
        assert list(reader.pushFilters(tests)) == []
        opened.clear()
        with open(f"{folder}/a.zip", "rb") as data:
            list(A.walk(data, lambda m, r=reader: r._holds("member", m), lambda a, r=reader: r._may_hold(a) and not opened.append(a)))
        assert opened == inner


def test_through_spark_alone(spark, folder):
    rows = read_zip(spark, f"{folder}/*.zip", ".txt").collect()
    assert {r.member: r.content for r in rows} == {"d/x.txt": "text", "in.zip!/deep.ZIP!/z.txt": "é"}


def test_faults(spark, folder, tmp_path):
    A.register(spark)
    with pytest.raises(Exception, match="path"):
        spark.read.format("archive").load().collect()
    data = {"x.txt": "1"}
    for _ in range(A.DEEPEST + 1):
        data = {"i.zip": data}
    with pytest.raises(ValueError, match="more than"):
        list(A.walk(io.BytesIO(packed(data))))
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    with pytest.raises(Exception, match="zip"):
        spark.read.format("archive").load(f"{tmp_path}/bad.zip").collect()
