"""Count-only Viterbi over a unigram vocabulary.

Pieces never hold a space mark after another character, nor a newline, so the
best path of a text is made of the best paths of its chunks, and a worker
keeps the results of the chunks it met.  A null or empty text has no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnspark.llm import pieces as P
from kilnspark.llm.common import small_batches, table, texts

CACHE = 400_000
_CHUNK = re.compile(f"{P.MARK}+[^{P.MARK}\n]*|[^{P.MARK}\n]+|\n")
_kept: dict[str, dict[str, tuple[float, int]]] = {}


def chunks(text: str) -> list[str]:
    """The text as the tokenizer sees it (a space mark before it and for each space), in chunks."""
    return _CHUNK.findall(P.MARK + text.replace(" ", P.MARK)) if text else []


def splits_cleanly(vocabulary: P.Pieces) -> bool:
    return not any("\n" in p or P.MARK in p.lstrip(P.MARK) for p in vocabulary.ids)


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = P.load(path)
        if not splits_cleanly(vocabulary):
            raise ValueError("a piece of this vocabulary spans chunks")
        unknown = min(vocabulary.scores) - 10.0
        cache = _kept.setdefault(path, {})
        for batch in small_batches(batches, "text", 4 << 20):
            counts, scores = [], []
            for text in texts(batch.column("text")):
                total, n = 0.0, 0
                for chunk in chunks(text.decode()):
                    found = cache.get(chunk)
                    if found is None:
                        found = P.viterbi(vocabulary, unknown, chunk)
                        if len(cache) < CACHE:
                            cache[chunk] = found
                    total += found[0]
                    n += found[1]
                counts.append(n)
                scores.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "n_tokens", "best_score"])

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, best_score)``, one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_run(vocabulary or P.default_path()), "doc_id long, n_tokens long, best_score double")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
