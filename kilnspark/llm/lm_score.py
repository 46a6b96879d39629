"""Subword lattice likelihood.

The scores of an existing unigram vocabulary give first probabilities of the
pieces; they weight all segmentations of the training words, and their
expected counts (one round of forward-backward over distinct words) plus the first probabilities
as a prior give the model.  Pieces never span words, so the forward recursion
over a word gives its marginal probability, and a document has the product of
its words' and the end's.

A pass over the texts writes, for blocks of documents of bounded size, the
distinct words and the documents as word numbers.  Word counts are joined by
word and go back to the blocks; texts are never shuffled, and the driver
receives one number for each piece of the vocabulary.

Null texts are empty (one token, the end); a null id counts as the empty id text;
repeated rows are documents of their own.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnspark.llm import pieces as P
from kilnspark.llm.common import materialise, small_batches, table, texts

BLOCK_BYTES = 24 << 20
PRIOR = 1000.0
ROWS_OUT = 50_000
_BLOCK = "block long, pos int, word binary, n long, ids array<long>, held array<boolean>, ends binary, idx binary, tf binary"


def _held(doc) -> bool:
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 10 == 0


def _flush(block: int, vocab: dict, train: np.ndarray, docs: list) -> Iterator[pa.RecordBatch]:
    words = list(vocab)
    schema = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("word", pa.binary()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("ends", pa.binary()), ("idx", pa.binary()), ("tf", pa.binary())])

    def rows(**cols) -> pa.RecordBatch:
        n = len(cols["block"])
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)

    for at in range(0, len(words), ROWS_OUT):
        part = words[at : at + ROWS_OUT]
        yield rows(block=[block] * len(part), pos=np.arange(at, at + len(part), dtype=np.int32), word=part, n=train[at : at + len(part)])
    ends = np.cumsum([len(d[2]) for d in docs]).astype("<i8").tobytes()
    pack = lambda k: zlib.compress(b"".join(d[k].astype("<i4").tobytes() for d in docs), 1)
    yield rows(block=[block], ids=[[d[0] for d in docs]], held=[[d[1] for d in docs]], ends=[ends], idx=[pack(2)], tf=[pack(3)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def fresh():
        vocab: dict = defaultdict()
        vocab.default_factory = vocab.__len__
        return vocab, [], 0

    part = TaskContext.get().partitionId() << 24
    number = 0
    vocab, docs, held_bytes = fresh()

    def close():
        train = np.zeros(len(vocab), dtype=np.int64)
        for _, held, idx, tf in docs:
            if not held:
                train[idx] += tf
        return _flush(part + number, vocab, train, docs)

    for batch in small_batches(batches, "text", 4 << 20):
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
            words = np.fromiter(map(vocab.__getitem__, text.lower().split()), dtype=np.int64)
            idx, tf = np.unique(words, return_counts=True)
            docs.append((doc, _held(doc), idx, tf))
            held_bytes += len(text) + 64
            if held_bytes > BLOCK_BYTES:
                yield from close()
                number += 1
                vocab, docs, held_bytes = fresh()
    if docs:
        yield from close()


def _expect(path: str, log_p: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = P.load(path)
        into: dict[int, float] = {}
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                P.expected(vocabulary, log_p, P.MARK + word.decode(), c, into)
        yield pa.RecordBatch.from_arrays([pa.array(list(into), pa.int32()), pa.array(list(into.values()), pa.float64())], names=["piece", "n"])

    return run


def _marginals(path: str, log_p: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = P.load(path)
        for batch in batches:
            found = [P.marginal(vocabulary, log_p, P.MARK + w.decode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(found, pa.float64())], names=["word", "c", "log_p"])

    return run


def _score(total: int, distinct: int, ends: int, log_end: float):
    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        count, log_p = np.zeros(size, dtype=np.int64), np.zeros(size)
        pos = right.column("pos").to_numpy()
        count[pos] = right.column("c").to_numpy()
        log_p[pos] = right.column("log_p").to_numpy()
        cols: list[list] = [[] for _ in range(6)]
        word_base = base(count)
        for row in left.to_pylist():
            idx = np.frombuffer(zlib.decompress(row["idx"]), dtype="<i4")
            tf = np.frombuffer(zlib.decompress(row["tf"]), dtype="<i4").astype(np.int64)
            cuts = np.frombuffer(row["ends"], dtype="<i8")
            at = 0
            for doc, held, to in zip(row["ids"], row["held"], cuts.tolist()):
                i, f = idx[at:to], tf[at:to]
                at = to
                values = (doc, held, int(f.sum()) + 1, int(f[count[i] > 0].sum()) + (ends > 0), float((word_base[i] * f).sum() + base(np.array([ends]))[0]), (float((log_p[i] * f).sum()) + log_end) / math.log(10))
                for col, value in zip(cols, values):
                    col.append(value)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
        arrays.insert(4, pa.array([total] * len(cols[0]), pa.int64()))
        return pa.Table.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def lattice_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    path = vocabulary or P.default_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = materialise(rows.mapInArrow(_blocks, _BLOCK))
    words = blocks.where("word is not null").select("block", "pos", "word", "n")
    counts = materialise(words.groupBy("word").agg(F.sum("n").alias("c")))
    ends = blocks.where("word is null").select(F.sum(F.size(F.filter("held", lambda h: ~h))).alias("n")).first()["n"] or 0
    some = counts.agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    total, distinct = (some["n"] or 0) + ends, (some["v"] or 0) + (ends > 0)

    pieces = P.load(path)
    first = P.prior(pieces)
    safe = lambda p: [math.log(x) if x > 0 else -math.inf for x in p]
    used = counts.where("c > 0").mapInArrow(_expect(path, safe(first)), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    expected = np.zeros(len(first))
    for row in used.collect():  # one row for each piece of the vocabulary at most
        expected[row["piece"]] = row["n"]
    weight = expected.sum() + PRIOR + ends + 1
    log_p = safe((expected + PRIOR * first) / weight)
    log_end = math.log((ends + 1) / weight)

    known = words.select("block", "pos", "word").join(counts.mapInArrow(_marginals(path, log_p), "word binary, c long, log_p double"), "word")
    left = blocks.where("word is null").select(F.col("block").alias("own"), "ids", "held", "ends", "idx", "tf")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    right = known.select(F.col("block").alias("other"), "pos", "c", "log_p")
    return left.groupBy("own").cogroup(right.groupBy("other")).applyInArrow(_score(total, distinct, ends, log_end), schema)


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"))
