"""Resumable sample buffers: batches of a fixed number of samples out of a stream, by shard.

The buffer is state of the stream: what a stopped run has not yet given out is in
its checkpoint, and the next run goes on with the batch after the last one, as if
it had never stopped.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Arrow-encoded list and value state live in this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCHES = "shard long, batch long, place int, position long, tokens array<int>"


class SampleBuffer(StatefulProcessor):
    """Samples ``(position, tokens)`` of a shard in order of position within each trigger.

    A batch is given out as soon as ``samples`` are there; a rest stays for the next
    trigger and, like a last incomplete batch, is never given out short.  More than
    ``most_tokens`` in the buffer is an error, raised before anything of that trigger is
    committed.
    """

    def __init__(self, samples: int, most_tokens: int = 1_000_000_000):
        if samples < 1:
            raise ValueError("a batch needs a sample")
        self.samples, self.most_tokens = samples, most_tokens

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "position long, tokens array<int>")
        self.facts = handle.getValueState("facts", "batch long, tokens long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        batch, size = tuple(self.facts.get()) if self.facts.exists() else (0, 0)
        waiting = [tuple(x) for x in self.held.get()] if self.held.exists() else []
        for position, tokens in sorted((r.position, r.tokens or []) for r in rows):
            size += len(tokens)
            if size > self.most_tokens:
                raise ValueError(f"shard {key[0]} holds {size} tokens, over {self.most_tokens}")
            waiting.append((position, tokens))
            if len(waiting) == self.samples:
                for place, (at, given) in enumerate(waiting):
                    yield Row(shard=key[0], batch=batch, place=place, position=at, tokens=given)
                waiting, size, batch = [], 0, batch + 1
        if waiting:
            self.held.put(waiting)
        elif self.held.exists():
            self.held.clear()
        self.facts.update((batch, size))

    def close(self) -> None:
        pass


def token_batches(stream: DataFrame, samples: int, most_tokens: int = 1_000_000_000) -> DataFrame:
    """``stream`` has ``shard``, ``position`` (long) and ``tokens`` (array<int>); batches of each shard are numbered from 0."""
    rows = stream.select(stream["shard"].cast("long").alias("shard"), stream["position"].cast("long").alias("position"), stream["tokens"].cast("array<int>").alias("tokens"))
    return rows.groupBy("shard").transformWithState(SampleBuffer(samples, most_tokens), BATCHES, "Append", "None")


def run_batches(stream: DataFrame, path: str, checkpoint: str, samples: int, most_tokens: int = 1_000_000_000) -> StreamingQuery:
    """Give out the batches of what has arrived, then stop; the same checkpoint resumes."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, STATE_STORE)
    try:
        query = token_batches(stream, samples, most_tokens).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        conf.set(key, before)
    return query
