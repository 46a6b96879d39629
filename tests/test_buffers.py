"""A stream of batches that stops and goes on equals one that never stopped."""

import pytest

from kilnspark.streaming import buffers
from kilnspark.streaming.ingest import read_files

SCHEMA = "shard long, position long, tokens array<int>"


def samples(n=230):
    return [(k % 3 if k % 10 else 0, k, [k] * (k % 7)) for k in range(n)]


def expected(rows, size):
    out, by = [], {}
    for shard, position, tokens in rows:
        by.setdefault(shard, []).append((position, tokens))
    for shard, held in by.items():
        for b in range(len(held) // size):
            out += [(shard, b, j, p, t) for j, (p, t) in enumerate(held[b * size : (b + 1) * size])]
    return sorted(out, key=str)


def land(spark, rows, folder, files):
    step = -(-len(rows) // files)
    for k in range(0, len(rows), step):
        spark.createDataFrame(rows[k : k + step], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def given(spark, folder):
    return sorted((tuple(r) for r in spark.read.parquet(folder).select("shard", "batch", "place", "position", "tokens").collect()), key=str)


def test_stopped_and_resumed(spark, tmp_path):
    rows, path = samples(), lambda n: f"file://{tmp_path}/{n}"
    # never stopped
    land(spark, rows, path("all"), 1)
    buffers.run_batches(read_files(spark, path("all"), SCHEMA), path("once"), path("state1"), 16)
    assert given(spark, path("once")) == expected(rows, 16)
    # stopped twice, in the middle of batches; one run starts with nothing new
    for a, b in ((0, 70), (70, 70), (70, 191), (191, 230)):
        if b > a:
            land(spark, rows[a:b], path("parts"), 1)
        buffers.run_batches(read_files(spark, path("parts"), SCHEMA), path("again"), path("state2"), 16)
        assert given(spark, path("again")) == expected(rows[:b], 16)


def test_overflow_is_an_error_and_nothing_is_lost(spark, tmp_path):
    rows, path = [(0, k, [1] * 10) for k in range(20)], lambda n: f"file://{tmp_path}/{n}"
    land(spark, rows, path("in"), 1)
    with pytest.raises(Exception, match="over 45"):
        buffers.run_batches(read_files(spark, path("in"), SCHEMA), path("out"), path("state"), 5, most_tokens=45)
    buffers.run_batches(read_files(spark, path("in"), SCHEMA), path("out"), path("state"), 5, most_tokens=50)
    assert given(spark, path("out")) == expected(rows, 5)


def test_odd_samples(spark, tmp_path):
    rows, path = [(None, 1, [1]), (None, 2, None), (4, 9, []), (4, -9, [2])], lambda n: f"file://{tmp_path}/{n}"
    land(spark, rows, path("in"), 1)
    buffers.run_batches(read_files(spark, path("in"), SCHEMA), path("out"), path("state"), 2)
    assert given(spark, path("out")) == sorted([(None, 0, 0, 1, [1]), (None, 0, 1, 2, []), (4, 0, 0, -9, [2]), (4, 0, 1, 9, [])], key=str)
    with pytest.raises(ValueError):
        buffers.SampleBuffer(0)
