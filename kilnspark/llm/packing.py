"""Best-two-fit packing of token sequences.

Lengths are whole numbers up to the capacity, so the packing is planned on
their histogram, which is as small as the capacity whatever the corpus: a bin
is filled greedily with the largest length that fits, then its smallest
document gives way to two unpacked ones that fill the widened gap more
tightly, if there are such; the pattern is used as often as the counts allow.  Each
document finds its bin from its rank among the documents of its length.  No task
sees more than its share of rows, and the driver sees ``capacity`` counts.

A null text is an empty one: one piece that holds only the end id.  Repeated
rows are packed each on its own.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import materialise, parts, release_memory, small_batches, table, texts

CAPACITY = 2048
CACHE = 450_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_kept: dict[str, ChunkTokenizer] = {}


class ChunkTokenizer:
    """Ids of a tokenizer that drops white space, from a cache of chunks.

    Pre-tokens never span white space there, so the ids of a text are those of its
    chunks between ASCII white space.  ASCII punctuation at a chunk's end, after
    an ASCII letter or digit, is a pre-token of its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        single = self.tokenizer.encode("a ; b", add_special_tokens=False).ids
        alone = self.tokenizer.encode(";", add_special_tokens=False).ids
        self.semicolon = alone[0] if len(alone) == 1 and single.count(alone[0]) == 1 else None

    def _encode(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each chunk.

        A chunk of letters is one pre-token, and its last id alone ends a word:
        such chunks go through in one text and are cut apart at those ids,
        if there is one for each; else, as all other chunks, one by one.
        """
        decoded = [c.decode() for c in chunks]
        letters = [k for k, c in enumerate(decoded) if c.isalpha()]
        out: dict[bytes, bytes] = {}
        if letters:
            whole = np.array(self.tokenizer.encode_batch_fast([" ".join([decoded[k] for k in letters])], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = 4 * (np.flatnonzero(self.ends[whole]) + 1)
            if len(cuts) == len(letters) and cuts[-1] == 4 * len(whole):
                raw, at = whole.tobytes(), 0
                for k, to in zip(letters, cuts.tolist()):
                    out[chunks[k]] = raw[at:to]
                    at = to
        rest = [k for k in range(len(chunks)) if chunks[k] not in out]
        # a semicolon between blanks is a pre-token of its own: chunks without one go through in one text as well
        joined = [k for k in rest if b";" not in chunks[k] and b"<|" not in chunks[k]] if self.semicolon is not None else []
        if joined:
            whole = np.array(self.tokenizer.encode_batch_fast([" ; ".join([decoded[k] for k in joined])], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(whole == self.semicolon)
            if len(cuts) == len(joined) - 1:
                raw, at = whole.tobytes(), 0
                for k, to in zip(joined, [*(4 * cuts).tolist(), len(raw)]):
                    out[chunks[k]] = raw[at:to]
                    at = to + 4
                rest = [k for k in rest if chunks[k] not in out]
        found = self.tokenizer.encode_batch_fast([decoded[k] for k in rest], add_special_tokens=False)
        return out | {chunks[k]: array("I", e.ids).tobytes() for k, e in zip(rest, found)}

    def ids(self, docs: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [(t if b"<|" in t else t.lower()).split() for t in docs]
        cache = self.cache
        new = set().union(*split) - cache.keys()
        stems = {}
        for c in new:
            stem = c.rstrip(PUNCTUATION)
            if stem is not c and stem != c and stem[-1:].isalnum() and b"<|" not in c:
                stems[c] = stem, c[len(stem) :]
        need = new - stems.keys()
        need.update(*stems.values())
        need -= cache.keys()
        fresh = self._encode(list(need))
        get = lambda x: fresh.get(x) or cache[x]
        fresh |= {c: get(stem) + get(tail) for c, (stem, tail) in stems.items()}
        # one table for the batch; what the cache has no room for leaves it afterwards
        cache.update(fresh)
        found = [b"".join(map(cache.__getitem__, chunks)) for chunks in split]
        over = len(cache) - CACHE
        if over > 0:
            for c in list(fresh)[-over:]:
                del cache[c]
        return found


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _kept:
            release_memory()  # the worker may have served another operator before
            _kept[path] = ChunkTokenizer(path)
        tokenizer = _kept[path]
        for batch in small_batches(batches, "text", 2 << 20):
            rows: list[tuple] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), tokenizer.ids(texts(batch.column("text")))):
                ids = raw + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Segments ``(length, first rank, documents per bin, bins, first bin, offset in bin)``."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    ranks: Counter[int] = Counter()
    segments, bins = [], 0
    while lengths:
        used: Counter[int] = Counter()
        room, top = capacity, len(lengths)
        while top:
            top = bisect_right(lengths, room, 0, top)
            while top and used[lengths[top - 1]] >= left[lengths[top - 1]]:
                top -= 1
            if top:
                n = lengths[top - 1]
                take = min(room // n, left[n] - used[n])
                used[n] += take
                room -= take * n
        if room:
            least = min(used)
            if two := _two(lengths, left, used, least, room + least):
                used[least] -= 1
                for n in two:
                    used[n] += 1
                used = +used
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for n in sorted(used, reverse=True):
            segments.append((n, ranks[n], used[n], times, bins, offset))
            ranks[n] += used[n] * times
            offset += used[n] * n
            left[n] -= used[n] * times
            if not left[n]:
                del lengths[lengths.index(n)]
        bins += times
    return segments


def _two(lengths: list[int], left: dict[int, int], used: Counter[int], least: int, gap: int) -> tuple[int, int] | None:
    """Two unpacked documents with the largest sum over ``least`` and within ``gap``."""
    free = [n for n in lengths[: bisect_right(lengths, gap)] if left[n] - used[n] > 0]
    lo, hi, best, found = 0, len(free) - 1, least, None
    while lo <= hi:
        a, b = free[lo], free[hi]
        if a + b > gap or (lo == hi and left[a] - used[a] < 2):
            hi -= 1
            continue
        if a + b > best:
            best, found = a + b, (a, b)
            if best == gap:
                break
        lo += 1
    return found


def _place(segments: list[tuple[int, int, int, int, int, int]]):
    def run(frames):
        by_length: dict[int, np.ndarray] = {}
        for s in segments:
            by_length.setdefault(s[0], []).append(s[1:])
        by_length = {n: np.array(x, dtype=np.int64) for n, x in by_length.items()}
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            seq, offset = np.empty(len(frame), dtype=np.int64), np.empty(len(frame), dtype=np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                parts_ = by_length[int(n)]
                s = parts_[np.searchsorted(parts_[:, 0], rank[at], "right") - 1]
                r = rank[at] - s[:, 0]
                seq[at] = s[:, 3] + r // s[:, 1]
                offset[at] = s[:, 4] + r % s[:, 1] * n
            yield frame.drop(columns=["rank"]).assign(sequence_id=seq, offset=offset)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers;
    without ``with_ids`` there is their checksum alone.  ``sequences`` joins them.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ids = ["ids"] if with_ids else []
    binary = ", ids binary" if with_ids else ""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = materialise(rows.mapInArrow(_pieces(tokenizer, capacity, with_ids), f"doc_id long, piece int, start long, length long, ids_crc32 long{binary}"))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * parts(docs.sparkSession)))
    counted = materialise(pieces.groupBy("length", salt.alias("salt")).agg(F.count("*").alias("n")))
    segments = plan({r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("salt", salt).withColumn("at", F.row_number().over(order)).join(offsets, ["length", "salt"])
    null_safe = ranked.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "piece", "start", "length", "ids_crc32", *ids, (F.col("before") + F.col("at") - 1).alias("rank"))
    placed = null_safe.mapInPandas(_place(segments), f"doc_id long, no_id boolean, piece int, start long, length long, ids_crc32 long{binary}, sequence_id long, offset long")
    return placed.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "piece", "start", "length", "ids_crc32", *ids, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the pieces of each sequence joined in the order of their offsets, ready for training."""
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"))
    return joined.select("sequence_id", "length", F.aggregate("x", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of all documents, with the checksums of their ids.

    Null and empty texts are pieces of the end id alone; rows without an id and
    repeated rows are packed each on its own; an empty table gives none.
    """
    return pack(docs, with_ids=False)


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
