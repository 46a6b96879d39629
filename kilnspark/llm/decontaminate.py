"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items are word sequences: A-Z lower-cased, punctuation
taken out, split at white space.  Windows of an item's own length slide over
the whole text and over its ends.  A passage of other length, with words inserted
or dropped, is met by the window that starts where it does: whatever the mix of
edits, that window keeps all but ``edits`` of the item's words, and all but
twice as many of its pairs of neighbouring words.  These exact counts, by running
sums and then of different pairs, spare the other windows.  The windows left and the items are embedded by CGK random
walks (position i moves on by a random bit that depends on step and symbol), so
that small edit distance becomes small Hamming distance; each of ``tables``
repetitions samples ``samples`` coordinates, and equal samples make a
candidate.  A banded-free dynamic programme over all candidates at once then
finds the exact edit distance of the item to the best passage of any length
around the window: its ends are free.

The benchmark side goes to every executor; ``MAX_ITEM_WORDS`` bounds it in one
piece, larger benchmarks are taken block by block.  Defined cases: null texts are empty;
items of one to four words allow no edit and are found where their words stand in a row; items without
words match nothing; repeated rows get equal results; other
columns are left alone; an empty benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kilnspark.llm.common import free_name, materialise, small_batches, table, texts
from kilnspark.llm.kernels import mix

TABLES = 24
SAMPLES = 2
#: Words of benchmark items that one pass holds, on the driver and in each worker.
MAX_ITEM_WORDS = 400_000
_PUNCT = b".,;:!?\"()[]{}'"
_LOWER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER_TABLE, _PUNCT).split()


class Index:
    """Benchmark items of one block, by length, with their sampled embeddings."""

    def __init__(self, items: list[tuple[int, bytes]], max_edits: float):
        self.max_edits = max_edits
        self.vocab: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if ids:
                by_length.setdefault(len(ids), []).append((item, ids))
        rng = np.random.default_rng(977)
        longest = max(by_length, default=0)
        # a random bit of the walks is the first of (number of the symbol * number of table and step), both odd and random;
        # the last two symbols stand for unknown words and the end
        self.symbols = rng.integers(0, 1 << 63, len(self.vocab) + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.steps = rng.integers(0, 1 << 63, (TABLES, 2 * longest), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        pairs = [np.zeros(0, dtype=np.int64)]
        pairs += [np.array(s[:-1], dtype=np.int64) * len(self.vocab) + s[1:] for group in by_length.values() for _, s in group if len(s) > 1]
        self.pairs = np.unique(np.concatenate(pairs))
        self.classes = []
        for n in sorted(by_length):
            ids = np.array([i for i, _ in by_length[n]])
            seqs = np.array([s for _, s in by_length[n]], dtype=np.int32)
            at = np.sort(np.array([rng.choice(2 * n, size=min(SAMPLES, 2 * n), replace=False) for _ in range(TABLES)]), axis=1)
            keys = self.sampled(seqs, at)
            order = np.argsort(keys, axis=1, kind="stable")
            own = np.unique(seqs[:, :-1].astype(np.int64) * len(self.vocab) + seqs[:, 1:])
            again = max(n - 1 - len(set(zip(s[:-1], s[1:]))) for _, s in by_length[n])
            self.classes.append((n, int(max_edits * n), ids, seqs, own, again, at, np.take_along_axis(keys, order, 1), order))

    def sampled(self, seqs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """By table, the hash of the embedded symbols of each sequence at the sampled coordinates."""
        n = seqs.shape[1]
        rows = np.arange(len(seqs))[None, :]
        padded = np.concatenate([seqs, np.full((len(seqs), 1), -1, dtype=np.int32)], axis=1)
        padded = np.where(padded < 0, len(self.vocab), padded)
        padded[:, n] = len(self.vocab) + 1
        place = np.zeros((TABLES, len(seqs)), dtype=np.int64)
        acc = np.zeros((TABLES, len(seqs)), dtype=np.uint64)
        for step in range(int(at.max()) + 1):
            symbol = padded[rows, place]
            if (take := (at == step).any(axis=1)).any():
                acc[take] = mix(acc[take] * np.uint64(0x2545F4914F6CDD1D) + symbol[take].astype(np.uint64) + np.uint64(1))
            place = np.minimum(place + (self.symbols[symbol] * self.steps[:, step, None] >> np.uint64(63)).astype(np.int64), n)
        return acc

    def search(self, docs: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(document, item, first word, edits) of each window within the allowed edits, best window of each item."""
        get = self.vocab.get
        # around each text as many words of none as a window may hang over, then a stop
        gap = np.full(max((c[1] for c in self.classes), default=0), -1, dtype=np.int32)
        stop = np.array([-2], dtype=np.int32)
        parts, owner_starts, owner_ends, total = [], [], [], 0
        for text in docs:
            ids = np.array(list(map(get, words_of(text), repeat(-1))), dtype=np.int32)
            owner_starts.append(total)
            owner_ends.append(total + len(gap) + len(ids))
            parts += [gap, ids, gap, stop]
            total += len(ids) + 2 * len(gap) + 1
        if not total:
            return []
        seq = np.concatenate(parts)
        known = (seq >= 0).astype(np.int32)
        known[seq == -2] = -(1 << 20)
        sums = np.concatenate(([0], np.cumsum(known, dtype=np.int64)))
        both = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0)) if len(self.pairs) else np.zeros(0, dtype=np.int64)
        codes = seq[both].astype(np.int64) * len(self.vocab) + seq[both + 1]
        held = np.zeros(len(seq), dtype=np.int32)
        if len(both):
            held[both[self.pairs[np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)] == codes]] = 1
        pair_sums = np.concatenate(([0], np.cumsum(held, dtype=np.int64)))
        blocks, ends = np.array(owner_starts), np.array(owner_ends)
        starts = blocks + len(gap)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for n, edits, ids, items, own, again, places, all_keys, all_orders in self.classes:
            if len(seq) < n:
                continue
            enough = sums[n:] - sums[:-n] >= n - edits
            if n > 1:
                enough &= pair_sums[n - 1 : -1] - pair_sums[:-n] >= n - 1 - 2 * edits
            near = np.flatnonzero(enough)
            for at in range(0, len(near), 20_000):
                where = near[at : at + 20_000]
                windows = seq[where[:, None] + np.arange(n)]
                if len(own):
                    # the pairs of this length's own items, counted in the windows that are left
                    pairs = windows[:, :-1].astype(np.int64) * len(self.vocab) + windows[:, 1:]
                    inside = own[np.minimum(np.searchsorted(own, pairs), len(own) - 1)] == pairs
                    inside &= (windows[:, :-1] >= 0) & (windows[:, 1:] >= 0)
                    kept = inside.sum(axis=1) >= n - 1 - 2 * edits
                    where, windows, pairs, inside = where[kept], windows[kept], pairs[kept], inside[kept]
                    # different ones: an item repeats ``again`` of its own pairs at most
                    codes = np.sort(np.where(inside, pairs, -1), axis=1)
                    different = (codes[:, 0] >= 0) + ((codes[:, 1:] != codes[:, :-1]) & (codes[:, 1:] >= 0)).sum(axis=1)
                    kept = different >= n - 1 - 2 * edits - again
                    where, windows = where[kept], windows[kept]
                if not len(where):
                    continue
                found = []
                # once more without the words that a passage with dropped words does not have
                walks = [self.sampled(windows[:, :size], places) for size in {n, n - edits}]
                for mine, keys, order in (x for walk in walks for x in zip(walk, all_keys, all_orders)):
                    lo, hi = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                    hit = np.flatnonzero(hi > lo)
                    many = hi[hit] - lo[hit]
                    first = np.repeat(hit, many)
                    inner = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
                    found.append(first * len(ids) + order[lo[first] + inner])
                candidates = np.unique(np.concatenate(found))
                w, i = candidates // len(ids), candidates % len(ids)
                for cut in range(0, len(w), 50_000):
                    ww, ii = w[cut : cut + 50_000], i[cut : cut + 50_000]
                    doc = np.searchsorted(blocks, where[ww], "right") - 1
                    # a window with enough words starts at most ``edits`` words off the passage, which has n + edits at most
                    spots = where[ww][:, None] + np.arange(-edits, n + 2 * edits)
                    inside = (spots >= starts[doc][:, None]) & (spots < ends[doc][:, None])
                    around = np.where(inside, seq[np.clip(spots, 0, len(seq) - 1)], -3)
                    distance, first = best_passages(around, items[ii])
                    ok = distance <= edits
                    doc = doc[ok]
                    place = np.maximum(spots[ok, 0] + first[ok] - starts[doc], 0)
                    for d, item, p, e in zip(doc.tolist(), ids[ii[ok]].tolist(), place.tolist(), distance[ok].tolist()):
                        if (d, item) not in best or (e, p) < best[d, item]:
                            best[d, item] = (e, p)
        return [(d, item, p, e) for (d, item), (e, p) in sorted(best.items())]


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distance of each row of ``a`` to the same row of ``b``."""
    rows, n = a.shape
    m = b.shape[1]
    last = np.repeat(np.arange(m + 1, dtype=np.int16)[None, :], rows, axis=0)
    steps = np.arange(m + 1, dtype=np.int16)
    for i in range(n):
        now = np.empty_like(last)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(last[:, 1:] + 1, last[:, :-1] + (b != a[:, i : i + 1]))
        last = np.minimum.accumulate(now - steps, axis=1) + steps
    return last[:, -1]


def best_passages(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of any passage of each row of ``a`` to the same row of ``b``, and its earliest start."""
    rows, n = a.shape
    m = b.shape[1]
    edit = np.int32(n + 1)  # a cell is edits * edit + start
    steps = np.arange(m + 1, dtype=np.int32) * edit
    last = np.repeat(steps[None, :], rows, axis=0)
    best = last[:, -1].copy()
    for i in range(n):
        now = np.empty_like(last)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(last[:, 1:] + edit, last[:, :-1] + (b != a[:, i : i + 1]) * edit)
        last = np.minimum.accumulate(now - steps, axis=1) + steps
        np.minimum(best, last[:, -1], out=best)
    return best // edit, best % edit


def _run(block: list[tuple[int, bytes]], max_edits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(block, max_edits)
        for batch in small_batches(batches, "text", 12 << 20):
            found = index.search(texts(batch.column("text")))
            items: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for d, item, place, edits in found:
                items[d].append({"item_id": item, "word": place, "edits": edits})
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int64()), ("edits", pa.int64())]))
            keep = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(items, kind)], names=[*batch.schema.names, "found"])

    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """Distinct items in blocks of at most MAX_ITEM_WORDS words; the driver holds one and the item that follows."""
    block: list[tuple[int, bytes]] = []
    held = 0
    for row in benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.coalesce(text_col, F.lit("")).alias("t")).distinct().orderBy("i", "t").toLocalIterator():
        n = len(words_of(row.t.encode()))
        if held and held + n > MAX_ITEM_WORDS:
            yield block
            block, held = [], 0
        block.append((row.i, row.t.encode()))
        held += n
    yield block


_LEAKS = "array<struct<item_id:bigint,word:bigint,edits:bigint>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edits: float = 0.2, into: str = "leaks") -> DataFrame:
    """``docs`` with the new column ``into``: array of (item_id, word, edits), one entry for each item found.

    With more items than one block holds, the result of each block is written
    before the next one is read.
    """
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    out = docs.withColumn(into, F.expr(f"cast(array() as {_LEAKS})"))
    blocks = _blocks(benchmark, item_id, item_text)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        out = _one_block(out, block, text_col, max_edits, into)
        if following is not None:
            out = materialise(out)
        block = following
    return out


def _one_block(docs: DataFrame, block: list[tuple[int, bytes]], text_col: str, max_edits: float, into: str) -> DataFrame:
    names = docs.columns
    moved = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("rest"))
    schema = StructType([*moved.schema.fields, StructField("found", docs.schema[into].dataType)])
    found = moved.mapInArrow(_run(block, max_edits), schema)
    inside = lambda c: F.col("rest").getField(c)
    back = [F.col("text").alias(c) if c == text_col else F.concat(inside(c), "found").alias(c) if c == into else inside(c).alias(c) for c in names]
    return found.select(*back)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go.

    Null and empty texts stay, repeated rows go or stay together, and with an empty benchmark nothing goes.
    """
    into = free_name(docs.columns, "leaks")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"), into=into).where(F.size(into) == 0).select(*docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.array_sort(F.transform("leaks", lambda x: x.item_id)).alias("item_ids"), F.array_min(F.transform("leaks", lambda x: x.edits)).alias("least_edits"))
