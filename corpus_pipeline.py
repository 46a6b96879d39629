"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kilnspark.llm.common import materialise, table
from kilnspark.llm.decontaminate import decontaminate_stage
from kilnspark.llm.line_rules import line_dedup_stage, quality_stage
from kilnspark.llm.near_dup import keep_one
from kilnspark.llm.packing import packing_stage

STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", keep_one),
    ("decontamination", decontaminate_stage),
    ("best_fit_packing", packing_stage),
]

#: MinHash, CGK embedding and packing can't be said in SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
