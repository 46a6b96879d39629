"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only local sessions may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if "dir" not in _own:
            _own["dir"] = tempfile.mkdtemp(prefix="kilnspark-work-")
            atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
        root = f"file://{_own['dir']}"
    return f"{root.rstrip('/')}/work-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write as a table and read it back: the lineage is cut."""
    path = folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
