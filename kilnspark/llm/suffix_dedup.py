"""Removal of long repeats, with longest-previous-factor arrays.

Two equal strings of ``width`` bytes (400), and as well two of ``ANCHOR`` bytes, hold an
equal anchor at the same place: the least hash among the substrings of ``KGRAM``
bytes of a window of ``ANCHOR``.  Anchors that occur once in the corpus can't lie in a
repeat, and most are of that kind.  Around each other one, the bytes of the
windows that it stands for are a context.  Contexts that are equal byte for
byte are one class, which knows how many there are and which is the first:
the others have it as their previous factor.

The different contexts of an anchor, in the order of their first places, are
sorted as suffixes by prefix doubling.  Previous and next smaller positions in
suffix order hold the longest earlier factor of a start, so comparing with these two
gives the longest previous factor, cut at ``width``: a start with one of full length is a
later copy.  A start repeats if that holds, or if it is the previous factor of
another: equal starts are neighbours in suffix order.

An anchor with more than ``GROUP`` different contexts is dealt by the whole
prefix of ``width`` bytes instead of by the anchor: the suffixes of such a part
are one run of the suffix order, the least position has no previous factor of
that length, and all others have it.  Parts meet partial aggregates first,
so that no task gets a hot anchor whole.

A text that repeats whole takes part once; later copies of it are later copies
from end to end.  Defined cases: null and empty texts have no spans; rows that
repeat a document (same id and text) are two occurrences; rows without an id are the last; texts
shorter than ``width`` bytes lose nothing; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import materialise, small_batches, table, texts
from kilnspark.llm.kernels import _SPACE, as_bytes, sliding_min, window_hashes, word_bounds

WIDTH = 400
ANCHOR = 320
KGRAM = 32
#: Different contexts of an anchor that are sorted together.
GROUP = 2048
CHUNK_BYTES = 1 << 18
#: Parts over which the rows of one anchor or one text are dealt.
SALTS = 8
#: Hot anchors up to which their list is broadcast (8 bytes each).
BROADCAST_ANCHORS = 1_000_000
#: Words of a passage that counts as a repeat although it is shorter than ``width`` bytes.
PASSAGE_WORDS = 50
_NO_ID = (1 << 63) - 1


def anchors(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors: every k-gram that is the least of some window."""
    hashes = window_hashes(as_bytes(text), KGRAM)
    span = width - KGRAM + 1
    if len(hashes) < span:
        return np.zeros(0, dtype=np.int64), hashes[:0]
    least = sliding_min(hashes, span)
    padded = np.concatenate([np.zeros(span - 1, dtype=np.uint64), least, np.zeros(span - 1, dtype=np.uint64)])
    highest = ~sliding_min(~padded, span)
    at = np.flatnonzero(hashes == highest)
    return at, hashes[at]


def window_anchor(text: bytes, width: int, hashes: np.ndarray) -> np.ndarray:
    """Position of the first least k-gram of each window, by the window's start."""
    span = width - KGRAM + 1
    if len(hashes) < span:
        return np.zeros(0, dtype=np.int64)
    at, keys = anchors(text, width)
    starts = np.arange(len(hashes) - span + 1)
    least = sliding_min(hashes, span)
    # first anchor at or after the start that has the window's least hash
    order = np.lexsort((at, keys))
    key_h, key_p = keys[order], at[order]
    rank = np.cumsum(np.concatenate(([0], key_h[1:] != key_h[:-1])))
    big = len(text) + 1
    own = rank[np.searchsorted(key_h, least, "left")]
    return key_p[np.searchsorted(rank * big + key_p, own * big + starts, "left")]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = [anchors(t, ANCHOR) for t in texts(batch.column("text"))]
        counts = [len(p) for p, _ in found]
        sha = batch.column("sha").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        grams = np.concatenate([h for _, h in found] or [np.zeros(0, np.uint64)])
        places = np.concatenate([p for p, _ in found] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([sha, pa.array(places, pa.int32()), pa.array(grams.view(np.int64), pa.int64())], names=["sha", "at", "gram"])


_CONTEXT = "k long, sha binary, start int, n int, words int, gram long, ctx binary, body binary"


def _contexts(width: int):
    """Around each anchor of ``places``: start and number of its windows, and the bytes from there to the end of the last window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows: list[tuple] = []
            for k, sha, text, places in zip(batch.column("k").to_pylist(), batch.column("sha").to_pylist(), texts(batch.column("text")), batch.column("places").to_pylist()):
                hashes = window_hashes(as_bytes(text), KGRAM)
                owner = window_anchor(text, ANCHOR, hashes)
                cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                ends = np.append(cut[1:], len(owner))
                wanted = np.isin(owner[cut], np.array(places, dtype=np.int64))
                first, last = cut[wanted], ends[wanted]
                grams = hashes[owner[first]].view(np.int64)
                starts = word_bounds(as_bytes(text))[0]
                words = np.searchsorted(starts, last - 1 + width) - np.searchsorted(starts, first)  # those that begin inside
                for i, j, w, g in zip(first.tolist(), last.tolist(), words.tolist(), grams.tolist()):
                    context = text[i : j - 1 + width]
                    rows.append((k, sha, i, j - i, w, g, hashlib.blake2b(context, digest_size=16).digest(), context))
            cols = list(zip(*rows)) or [[]] * 8
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["k", "sha", "start", "n", "words", "gram", "ctx", "body"])

    return run


# ---------------------------------------------------------------- suffix order and factors


def prefix_ranks(data: np.ndarray, width: int, wanted: np.ndarray | None = None) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, ... bytes and by their first ``width``.

    Prefix doubling; the last round overlaps, so that it compares exactly
    ``width`` bytes.  With ``wanted`` (starts as a mask), rounds leave out suffixes that no
    wanted rank needs; their ranks stay 0.  Behind the end come zeros.
    """
    n = len(data)
    first = min(8, width)
    key = np.zeros(n, dtype=np.uint64)
    for j in range(first):
        key[: n - j] |= data[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    lengths = [first]
    while lengths[-1] < width:
        lengths.append(min(2 * lengths[-1], width))
    needed = [np.ones(n, dtype=bool)] * len(lengths)
    if wanted is not None:
        here = np.arange(n)
        back = here - np.maximum.accumulate(np.where(wanted, here, -width))  # from the last wanted start
        # a rank of a length is asked for at most ``width`` less that length behind a wanted start
        needed = [back <= width - length for length in lengths[:-1]] + [wanted]
    out = {}
    for level, length in enumerate(lengths):
        at = np.flatnonzero(needed[level])
        if level:
            held = lengths[level - 1]
            later = at + (length - held)
            inside = later < n
            part = out[held][at] * np.int64(n + 1)
            part[inside] += out[held][later[inside]]
        else:
            part = key[at]
        order = np.argsort(part)
        ordered = part[order]
        rank = np.zeros(n, dtype=np.int64)
        if len(at):
            rank[at[order]] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        out[length] = rank
    return out


def smaller_neighbours(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the suffix order, the nearest place before and after it with a smaller position.

    All between a place and its pointer have larger positions, so a pointer to a
    larger position may jump on by that one's pointer.  -1 and n: there is none.
    """
    n = len(positions)
    both = []
    for p in (positions, positions[::-1]):
        padded = np.append(p, -1)  # the last element stands for none: smaller than all
        jump = np.append(np.arange(n) - 1, n)
        jump[jump < 0] = n
        todo = np.arange(n)
        while len(todo):
            todo = todo[padded[jump[todo]] > p[todo]]
            jump[todo] = jump[jump[todo]]
        both.append(np.where(jump[:n] == n, -1, jump[:n]))
    return both[0], np.where(both[1][::-1] < 0, n, n - 1 - both[1][::-1])


def same_prefix(ranks: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` share their first ``length`` bytes: two overlapping ranks tell.

    Those of ``a`` must lie before the separator that ends the data.
    """
    out, last = np.zeros(len(a), dtype=bool), len(next(iter(ranks.values()))) - 1
    known = sorted(ranks)
    for held, above in zip(known, [*known[1:], known[-1] + 1]):
        at = np.flatnonzero((length >= held) & (length < above))
        r, shift = ranks[held], length[at] - held
        out[at] = (r[a[at]] == r[b[at]]) & (r[a[at] + shift] == r[np.minimum(b[at] + shift, last)])
    return out


def longest_previous(data: np.ndarray) -> np.ndarray:
    """The whole longest-previous-factor array of a short text, from previous and next smaller positions."""
    n = len(data)
    ranks = prefix_ranks(data, max(1, n))
    order = np.argsort(ranks[max(ranks)])
    before, after = smaller_neighbours(order)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)

    def common(i: int, j: int) -> int:
        a, b = data[i:], data[j:]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        return int(differ[0]) if len(differ) else m

    return np.array([max([common(i, int(order[k])) for k in (before[place[i]], after[place[i]]) if 0 <= k < n], default=0) for i in range(n)], dtype=np.int64)


def _words_from(data: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of words that follow a space, and the bytes of ``count`` words from there (0: fewer words follow)."""
    space = _SPACE[data] | (data == 255)
    begins = np.flatnonzero(~space[1:] & space[:-1]) + 1
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    if len(begins):
        ends = ends[np.searchsorted(ends, begins[0], "right") :]  # from the end of the first of these words on
    size = np.zeros(len(begins), dtype=np.int64)
    if len(begins) >= count:
        m = len(begins) - count + 1
        size[:m] = ends[count - 1 : count - 1 + m] - begins[:m]
    return begins, size


def _classify(width: int, passage_words: int):
    """Contexts sorted by anchor and first place: which starts of each have an earlier copy, and which any; whether a passage of so many words repeats."""

    def chunk(rows: list[tuple]) -> list[tuple]:
        sizes = np.array([len(r[3]) for r in rows])
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        total = int(sizes.sum()) + len(rows)
        data = np.frombuffer(b"\xff".join([r[3] for r in rows]) + b"\xff", dtype=np.uint8)
        grams = np.array([r[0] for r in rows])
        group = np.repeat(np.cumsum(np.concatenate(([0], grams[1:] != grams[:-1]))), sizes + 1)
        counts = np.array([r[2] for r in rows])
        edge = np.zeros(total + 1, dtype=np.int32)
        edge[begins] += 1
        edge[begins + counts] -= 1
        starts_here = np.cumsum(edge[:-1]) > 0
        end_of = np.repeat(begins + sizes, sizes + 1)
        ranks = prefix_ranks(data, width, starts_here)
        s = np.flatnonzero(starts_here)
        # suffix order within each anchor; equal prefixes by position
        by = np.argsort((group[s] * np.int64(total + 1) + ranks[width][s]) * np.int64(total + 1) + s) if len(rows) * float(total) ** 2 < 2e18 else np.lexsort((s, ranks[width][s], group[s]))
        order = s[by]
        g, n = group[order], len(order)
        whole = end_of[order] - order >= width
        earlier, either, passage = np.zeros(total, dtype=bool), np.zeros(total, dtype=bool), np.zeros(total, dtype=bool)
        before, after = smaller_neighbours(order)
        words_at, words_len = _words_from(data, passage_words)
        wanted = np.zeros(total, dtype=np.int64)
        wanted[words_at] = np.where((words_len < width) & (words_at + words_len <= end_of[words_at]), words_len, 0)
        asked = wanted[order]
        here = np.arange(n)
        for neighbour, into in ((before, earlier), (after, earlier), (here - 1, either), (here + 1, either)):
            ok = np.flatnonzero((neighbour >= 0) & (neighbour < n))
            ok = ok[g[ok] == g[neighbour[ok]]]
            full = ok[whole[ok]]
            same = ranks[width][order[full]] == ranks[width][order[neighbour[full]]]
            into[order[full[same]]] = True
            if into is either:
                some = ok[asked[ok] > 0]
                passage[order[some[same_prefix(ranks, order[some], order[neighbour[some]], asked[some])]]] = True
        either |= earlier
        at = begins.tolist()
        cut = lambda flags, b, k: np.packbits(flags[b : b + k]).tobytes()
        return [(gram, ctx, cut(earlier, b, k), cut(either, b, k), bool(passage[b : b + k].any() or either[b : b + k].any())) for (gram, ctx, k, *_), b in zip(rows, at)]

    def emit(rows: list[tuple], alone: list[tuple]) -> pa.RecordBatch:
        found = (chunk(rows) if rows else []) + [(gram, ctx, None, None, False) for gram, ctx, *_ in alone]
        known = [(*f, *row[4:]) for f, row in zip(found, rows + alone) if f[4] or row[4] > 1]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
        columns = list(zip(*known)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["gram", "ctx", "earlier", "either", "passage", "same", "k", "sha", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        own: list[tuple] = []
        alone: list[tuple] = []  # anchors with one context: it has no other to be compared with
        held_bytes = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "ctx", "n", "body", "same", "k", "sha", "start"))):
                if own and own[0][0] != row[0]:
                    if len(own) == 1:
                        alone += own
                    else:
                        held += own
                        held_bytes += sum(len(r[3]) for r in own)
                    own = []
                    if held_bytes > CHUNK_BYTES or len(alone) > 10_000:
                        yield emit(held, alone)
                        held, alone, held_bytes = [], [], 0
                own.append(row)
        yield emit(held + own * (len(own) > 1), alone + own * (len(own) == 1))

    return run


def _prefix_rows(width: int, passage_words: int):
    """The suffixes of a hot anchor's contexts by the hash of their whole prefix: of ``width`` bytes, and of so many words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", 1 << 20):
            found: list[tuple] = []
            for row, (body, count) in enumerate(zip(batch.column("body").to_pylist(), batch.column("n").to_pylist())):
                data = np.frombuffer(body + b"\xff", dtype=np.uint8)
                hashes = window_hashes(data[:-1], width).view(np.int64)[:count]
                found.append((np.full(len(hashes), row), np.zeros(len(hashes), dtype=np.int32), np.arange(len(hashes), dtype=np.int32), hashes))
                at, size = _words_from(data, passage_words)
                keep = (size > 0) & (size < width) & (at < count)
                words = np.array([hash_of(body[a : a + k]) for a, k in zip(at[keep].tolist(), size[keep].tolist())], dtype=np.int64)
                found.append((np.full(len(words), row), np.ones(len(words), dtype=np.int32), at[keep].astype(np.int32), words))
            rows, kind, at, prefix = (np.concatenate(c) for c in zip(*found))
            pick = pa.array(rows)
            keys = [batch.column(c).take(pick) for c in ("gram", "ctx", "first")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(prefix, pa.int64())], names=["gram", "ctx", "first", "kind", "at", "prefix"])

    return run


def hash_of(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


# ---------------------------------------------------------------- answers


def _cover(n: int, parts: dict[str, list], rows: range, name: str, width: int) -> np.ndarray:
    """Bytes that lie in a string of ``width`` from one of the starts that ``name`` flags."""
    edge = np.zeros(n + 1, dtype=np.int32)
    starts, counts, whole, bits, places = (parts[c] for c in ("start", "n", f"all_{name}", name, f"{name}_at"))
    for r in rows:
        first = starts[r]
        if whole[r]:
            stop = min(first + counts[r], n - width + 1)
            if stop > first:
                edge[first] += 1
                edge[stop - 1 + width] -= 1
            continue
        if bits[r] is not None:
            at = first + np.flatnonzero(np.unpackbits(np.frombuffer(bits[r], dtype=np.uint8), count=counts[r]))
        else:
            at = first + np.array(places[r] or [], dtype=np.int64)
        edge[at] += 1
        edge[at + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def _runs(gone: np.ndarray) -> list[dict]:
    steps = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
    return [{"start": a, "end": b} for a, b in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist())]


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _spans(width: int, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out: list[tuple] = []
            found = batch.column("found")
            cuts = found.offsets.to_pylist()
            flat = found.values  # from the first offset of the whole column on
            parts = {flat.type.field(c).name: flat.field(c).to_pylist() for c in range(flat.type.num_fields)}
            for k, (sha, text) in enumerate(zip(batch.column("sha").to_pylist(), texts(batch.column("text")))):
                rows = range(cuts[k], cuts[k + 1])
                later, any_ = (_cover(len(text), parts, rows, name, width) for name in ("earlier", "either"))
                gone = later if keep_first else any_
                out.append((sha, _runs(gone), np.frombuffer(text, dtype=np.uint8)[~gone].tobytes() if gone.any() else None, int(later.sum()), any(parts["passage"][r] for r in rows)))
            kinds = [pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["sha", "spans", "kept", "n_later", "repeats"])

    return run


def _salt(column: str):
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def _all_salts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


_FLAGS = "gram long, ctx binary, earlier binary, either binary, passage boolean, same long, k long, sha binary, start int"


def _flags(classes: DataFrame, width: int, passage_words: int) -> DataFrame:
    """Of each class that repeats in some place: its flags, or for hot anchors the places themselves."""
    crowded = materialise(classes.groupBy("gram").agg(F.count("*").alias("different")).where(F.col("different") > GROUP).select("gram"))
    many = crowded.count()
    side = F.broadcast(crowded) if many <= BROADCAST_ANCHORS else crowded
    small = classes.join(side, "gram", "left_anti") if many else classes
    dealt = small.repartition("gram").sortWithinPartitions("gram", "k", "sha", "start")
    flags = dealt.mapInArrow(_classify(width, passage_words), _FLAGS).withColumns({c: F.lit(None).cast("array<int>") for c in ("earlier_at", "either_at")})
    if not many:
        return flags
    large = classes.join(side, "gram", "left_semi")
    first = F.struct("k", "sha", "start")
    suffixes = large.select("gram", "ctx", "n", first.alias("first"), "body").mapInArrow(_prefix_rows(width, passage_words), "gram long, ctx binary, first struct<k:bigint,sha:binary,start:int>, kind int, at int, prefix long")
    spot = F.struct("first", "at")
    runs = suffixes.groupBy("gram", "kind", "prefix").agg(F.count("*").alias("size"), F.min(spot).alias("least")).where("size > 1")
    hot = suffixes.join(runs, ["gram", "kind", "prefix"]).groupBy("gram", "ctx").agg(
        F.collect_list(F.when((F.col("kind") == 0) & (spot > F.col("least")), F.col("at"))).alias("earlier_at"), F.collect_list(F.when(F.col("kind") == 0, F.col("at"))).alias("either_at")
    )
    found = large.drop("n", "body").join(hot, ["gram", "ctx"], "left").withColumn("passage", F.col("either_at").isNotNull()).where("passage or same > 1")
    return flags.unionByName(found, allowMissingColumns=True)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, keep_first: bool = False, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, text_sha256, spans, kept, n_later, repeats``.

    ``spans`` are the removed runs of bytes (start, end exclusive) and ``kept``
    the bytes that are left (null: all).  Every copy goes, or with ``keep_first`` all but the
    first in the order of id, text hash and place.  ``n_later`` counts the bytes in
    strings of ``width`` that occur earlier too (rows with id and text of the first copy are no later ones); ``repeats`` tells of such a string anywhere else, or of
    ``passage_words`` words in a row (found for certain from ``ANCHOR`` bytes on).
    """
    if width < ANCHOR:
        raise ValueError(f"width is {ANCHOR} at least")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    named = rows.withColumn("hex", F.sha2("text", 256)).withColumn("k", F.coalesce("doc_id", F.lit(_NO_ID)))
    # the first 128 bits of the hash name a text
    named = named.withColumn("sha", F.unhex(F.substring("hex", 1, 32))).withColumn("salt", _salt("k"))
    parts = named.groupBy("sha", "salt").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    alone = Window.partitionBy("sha")  # at most SALTS rows
    copies = materialise(parts.select("sha", "salt", F.sum("n").over(alone).alias("copies"), F.min("k").over(alone).alias("rep")))

    long_ = named.where(F.octet_length("text") >= ANCHOR)
    grams = materialise(long_.select("sha", "text").mapInArrow(_anchor_rows, "sha binary, at int, gram long"))
    # an anchor that occurs at two places; copies of a text are one place
    spots = grams.groupBy("gram").agg(F.min(F.xxhash64("sha", "at")).alias("lo"), F.max(F.xxhash64("sha", "at")).alias("hi"))
    again = _all_salts(spots.where("lo <> hi").select("gram"))
    places = grams.withColumn("salt", _salt("sha")).join(again, ["gram", "salt"]).groupBy("sha").agg(F.collect_set("at").alias("places"))
    rep = places.join(copies.groupBy("sha").agg(F.min("rep").alias("k")), "sha")
    once = materialise(long_.select("sha", "k", "text").join(rep, ["sha", "k"]).dropDuplicates(["sha", "k"]))
    contexts = materialise(once.mapInArrow(_contexts(width), _CONTEXT))

    place = F.struct("k", "sha", "start")
    classes = contexts.groupBy("gram", "ctx").agg(F.count("*").alias("same"), F.min(place).alias("first"), F.min("n").alias("n"), F.min("body").alias("body"))
    classes = materialise(classes.select("gram", "ctx", "same", "n", "body", "first.*"))
    flags = _flags(classes, width, passage_words)
    known = flags.select("gram", "ctx", "earlier", "either", "passage", "same", "earlier_at", "either_at", F.struct("k", "sha", "start").alias("first"))
    answer = contexts.select("k", "sha", "start", "n", "words", "gram", "ctx").join(known, ["gram", "ctx"])
    several = F.col("same") > 1
    passage = F.col("passage") | (several & (F.col("words") >= passage_words))
    part = F.struct("start", "n", (several & (place > F.col("first"))).alias("all_earlier"), several.alias("all_either"), "earlier", "either", "earlier_at", "either_at", passage.alias("passage"))
    found = answer.groupBy("sha").agg(F.collect_list(part).alias("found"))
    done = once.select("sha", "text").join(found, "sha").mapInArrow(_spans(width, keep_first), f"sha binary, spans {_SPANS}, kept binary, n_later long, repeats boolean")

    # a text that repeats whole needs its bytes for the first copy alone, and only if that one is kept
    own = F.col("copies") == 1
    info = copies.join(done, "sha", "left").withColumn("kept", F.when(own | (F.lit(keep_first) & (F.col("salt") == _salt("rep"))), F.col("kept")))
    narrow = named.select("doc_id", "k", "hex", "sha", "salt", F.octet_length("text").cast("long").alias("n_bytes"))
    joined = narrow.join(info, ["sha", "salt"])
    long_copy = (F.col("copies") > 1) & (F.col("n_bytes") >= width)
    later_copy = long_copy & (F.col("k") != F.col("rep"))
    whole = later_copy if keep_first else long_copy
    return joined.select(
        "doc_id", "n_bytes", F.col("hex").alias("text_sha256"),
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(later_copy, F.col("n_bytes")).otherwise(F.coalesce("n_later", F.lit(0))).cast("long").alias("n_later"),
        (F.coalesce("repeats", F.lit(False)) | ((F.col("copies") > 1) & (F.col("n_bytes") >= ANCHOR))).alias("repeats"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.start)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.coalesce(F.sha2("kept", 256), "text_sha256").alias("kept_sha256"), "n_later", "repeats")
