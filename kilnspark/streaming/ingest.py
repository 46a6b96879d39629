"""Structured Streaming: the batch transforms over files that arrive, and event-time extensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilnspark.operators.curate import quality_flag


def read_files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(kind)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def curate_stream(docs: DataFrame) -> DataFrame:
    """The quality filter, stateless."""
    return docs.where(quality_flag(F.col("text")))


def hash_split(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """Stateless validation split: a row's side depends on its key alone."""
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("split", F.when(place < share, "val").otherwise("train"))


def dedupe_stream(df: DataFrame, ts: str, text: str, delay: str) -> DataFrame:
    """Extension: exact dedup within the watermark."""
    return df.withWatermark(ts, delay).withColumn("_h", F.sha1(text)).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def check_options(val_size: float = 0, max_samples: int | None = None, has_eval: bool = False) -> None:
    """Options that a stream of unknown length can't have are errors: a share of its rows, a number of its first rows, two sources of validation rows."""
    if 0 < val_size < 1:
        raise ValueError("a stream takes a number of validation rows, not a share")
    if max_samples is not None:
        raise ValueError("a stream can't be cut after a number of rows")
    if val_size and has_eval:
        raise ValueError("validation rows come from the stream or from a dataset, not from both")


def window_counts(df: DataFrame, ts: str, key: str, size: str, delay: str, slide: str | None = None) -> DataFrame:
    """Extension: rows by tumbling or, with ``slide``, sliding window and key; rows later than ``delay`` are dropped once their window is given out."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.withWatermark(ts, delay).groupBy(window, key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def session_counts(df: DataFrame, ts: str, key: str, gap: str, delay: str) -> DataFrame:
    """Extension: rows by session of a key; a session ends ``gap`` after its last row."""
    sessions = df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
    return sessions.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has arrived and stop; the checkpoint makes the next run resume."""
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_available_batches(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Aggregates of all that has arrived: each batch replaces the table by the complete result, and the last one stays."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
