"""Published tables: failed writes, conflicts, batches delivered twice."""

import time

import pytest
from pyspark.sql import functions as F

from kilnspark.sources import publish as P


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return P.Published(spark, f"file://{tmp_path}/t")


def test_a_write_that_dies_half_way_leaves_the_old_version(spark, table):
    assert table.read() is None
    table.publish(spark.range(5))
    broken = spark.range(0, 1000, numPartitions=4).select(F.when(F.col("id") > 700, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).cast("long").alias("id"))
    calls = []
    with pytest.raises(Exception, match="dies"):
        table.change(lambda old: calls.append(1) or broken, tries=3, wait=0.01)
    assert len(calls) == 3 and rows(table) == [(k,) for k in range(5)]
    # a pointer that was cut off counts for nothing, but its number is used up
    table.files.create("pointers/000000000002", b'{"vers')
    assert rows(table) == [(k,) for k in range(5)]
    assert table.change(lambda old: old.where("id > 2"))["number"] == 3 and rows(table) == [(3,), (4,)]
    assert table.vacuum(1) >= 1 and rows(table) == [(3,), (4,)]


def test_waits_double(monkeypatch):
    waits, left = [], [3]
    monkeypatch.setattr(time, "sleep", waits.append)

    def action():
        left[0] -= 1
        if left[0]:
            raise OSError("again")
        return "done"

    assert P.with_retries(action) == "done" and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        P.with_retries(lambda: (_ for _ in ()).throw(OSError("never")))


def test_two_writers(spark, table):
    table.publish(spark.range(1))
    head = table.head()
    table.publish(spark.range(2), after=head)
    with pytest.raises(P.Conflict):
        table.publish(spark.range(3), after=head)
    assert rows(table) == [(0,), (1,)]
    # a change is made anew from what the other one has published
    tried = []

    def build(old):
        if not tried:
            tried.append(1)
            table.publish(spark.range(10, 12), after=table.head())
        return old.union(spark.range(99, 100))

    table.change(build, wait=0.01)
    assert rows(table) == [(10,), (11,), (99,)]


def test_upserts_and_batches(spark, table):
    frame = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    table.upsert(frame((1, "a"), (None, "n")), ["k"], batch=7)
    table.upsert(frame((1, "b"), (2, "c"), (None, "m")), ["k"], batch=8)
    assert rows(table) == sorted([(1, "b"), (2, "c"), (None, "m")], key=str)
    number = table.head()["number"]
    for old in (8, 7):
        table.upsert(frame((1, "late")), ["k"], batch=old)
    assert table.head()["number"] == number
    table.upsert(spark.createDataFrame([(1, 5)], "k int, w int"), ["k"], batch=9)
    assert {r.k: (r.v, r.w) for r in table.read().collect()} == {1: ("b", 5), 2: ("c", None), None: ("m", None)}


def test_scrubbed_lines(spark, tmp_path):
    t = P.Published(spark, f"file://{tmp_path}/lines", "text")
    assert P.scrub_lines(t) == 0
    t.publish(spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ("",), ('{"a": 2}{"a": 3}',), ("[1]",)], "value string"))
    assert P.scrub_lines(t) == 2 and rows(t) == [("[1]",), ('{"a": 1}',)]
    number = t.head()["number"]
    assert P.scrub_lines(t) == 0 and t.head()["number"] == number
