"""Late rows of a stream, and packing bin by bin."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kilnspark.operators import samples as S
from kilnspark.streaming import ingest as I

EVENTS = "ts timestamp, key string"


def at(minutes):
    return datetime(2030, 1, 1) + timedelta(minutes=minutes)


def land(spark, rows, folder):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_dropped_after_their_window_is_given_out(spark, tmp_path):
    path = lambda n: f"file://{tmp_path}/{n}"
    run = lambda: I.run_available(I.window_counts(I.read_files(spark, path("in"), EVENTS), "ts", "key", "10 minutes", "5 minutes"), path("out"), path("state"))
    land(spark, [(at(1), "a"), (at(2), "a"), (at(12), "a")], path("in"))
    run()
    land(spark, [(at(9), "a"), (at(40), "a")], path("in"))  # nine is late, but its window is still open
    run()
    land(spark, [(at(3), "a"), (at(80), "a")], path("in"))  # three is too late
    run()
    found = {(r.start, r.n) for r in spark.read.parquet(path("out")).collect()}
    assert found == {(at(0), 3), (at(10), 1), (at(40), 1)}


def test_sliding_windows_and_sessions(spark, tmp_path):
    path = lambda n: f"file://{tmp_path}/{n}"
    land(spark, [(at(1), "a"), (at(6), "a"), (at(30), "a"), (at(31), "b")], path("in"))
    s = I.read_files(spark, path("in"), EVENTS)
    I.run_available_batches(I.window_counts(s, "ts", "key", "10 minutes", "1 minute", "5 minutes"), path("slide"), path("s1"))
    assert {(r.start, r.key, r.n) for r in spark.read.parquet(path("slide")).collect()} == {(at(-5), "a", 1), (at(0), "a", 2), (at(5), "a", 1), (at(25), "a", 1), (at(30), "a", 1), (at(25), "b", 1), (at(30), "b", 1)}
    I.run_available_batches(I.session_counts(s, "ts", "key", "7 minutes", "1 minute"), path("session"), path("s2"))
    assert {(r.start, r.end, r.key, r.n) for r in spark.read.parquet(path("session")).collect()} == {(at(1), at(13), "a", 2), (at(30), at(37), "a", 1), (at(31), at(38), "b", 1)}


def test_options_that_streams_can_not_have():
    I.check_options()
    I.check_options(val_size=100)
    for options in ({"val_size": 0.1}, {"max_samples": 5}, {"val_size": 10, "has_eval": True}):
        with pytest.raises(ValueError):
            I.check_options(**options)


def test_greedy_packing_bin_by_bin(spark):
    rng = random.Random(9)
    rows = [(k % 3, k, rng.randrange(1, 120)) for k in range(400)]
    df = spark.createDataFrame(rows, "shard long, id long, length long")
    bins, size = {}, {k: n for _, k, n in rows}
    for r in S.knapsack(df, "id", "length", 100, F.col("shard")).collect():
        bins.setdefault((r.shard, r.bin), []).append((r.offset, size[r.id]))
    for shard in range(3):
        left = sorted(n for s, _, n in rows if s == shard and n <= 100)
        want = []
        while left:
            room, taken = 100, []
            while fits := [n for n in left if n <= room]:
                taken.append(fits[-1])
                left.remove(fits[-1])
                room -= fits[-1]
            want.append(taken)
        found = [[n for _, n in sorted(bins[s, b])] for s, b in sorted(bins) if s == shard]
        assert found == want
        assert all(o == sum(n for _, n in x[:i]) for (s, _), v in bins.items() if s == shard for x in [sorted(v)] for i, (o, _) in enumerate(x))
