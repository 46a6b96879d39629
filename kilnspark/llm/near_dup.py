"""HyperMinHash near-duplicates.

Each set of word shingles gets a sketch of ``BUCKETS`` registers.  One hash of a
shingle chooses the bucket by its first bits; the register holds the
leading-zero count of the least remainder in its bucket and the mantissa bits that
follow, 16 bits in all; a bucket without shingles is empty.  For banding, an empty bucket
borrows the register of another, the first filled one in an order of its own, so that
short texts give keys as selective as long ones; bands of four registers give candidates.  Register matches among the buckets that either set fills, corrected for
the collisions to be expected of sets of these sizes, estimate the Jaccard
similarity; they rank partners and spare pairs that are far off, and full shingle sets decide.

At similarity 0.8 a pair shares no band with probability (1 - 0.8**4)**32 = 5e-8,
and the spared pairs are those with so few matches that a pair at the threshold
has them with probability ``MISS`` (1e-9) at most, whatever the number of filled buckets.

No bucket of a hot group is expanded into all pairs.  Identical sets are one
class.  Within a band bucket, in tiles of bounded size, each class proposes its
best-estimated partner and its best among the classes before it in a hashed
order.  After these are verified, a bucket whose members lie in one component is done;
in others the members of the largest component meet those outside it, and these each other,
in tiles.  Two members of the largest component are not brought together again.
There registers are compared first, and only rows with a partner that may be linked with them
are dealt again with their sets, which are many times as large.

Rows that share a ``doc_id`` are one document with several sets, and it is linked by each of them.
Rows without ``doc_id`` are kept and take no part.  Texts without words have an
empty set and are linked with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import components, materialise, small_batches, table, texts
from kilnspark.llm.kernels import mix, shingle_set

BUCKETS = 128
ROWS = 4
MANTISSA = 10
TILE = 512
SALTS = 8
#: Chance that a pair at the threshold has too few register matches to be verified.
MISS = 1e-9

_REST = 64 - BUCKETS.bit_length() + 1  # bits that follow the bucket
_EMPTY = 0xFFFF
#: Columns of a row's place in a pair of tiles, and those that name the pair.
_PLACE = {"id": "long", "bucket": "long", "component": "long", "inner": "int", "t1": "int", "t2": "int", "side": "int"}
_TILES = ["bucket", "inner", "t1", "t2"]
_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(_REST)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Compressed registers of sorted shingle hashes: leading zeros * 2**MANTISSA + mantissa, as uint16.

    Sorted hashes lie bucket by bucket, the least remainder first.
    """
    at = np.searchsorted(shingles, _STARTS)
    least = shingles[np.minimum(at, len(shingles) - 1)]
    filled = (at < len(shingles)) & (least >> np.uint64(_REST) == np.arange(BUCKETS, dtype=np.uint64))
    rest = (least & np.uint64((1 << _REST) - 1)) >> np.uint64(_REST - 32)
    exponent = np.frexp(rest.astype(np.float64))[1]
    shift = (exponent - 1 - MANTISSA).clip(0).astype(np.uint64)
    lift = (MANTISSA - exponent + 1).clip(0).astype(np.uint64)
    mantissa = ((rest >> shift) << lift) & np.uint64((1 << MANTISSA) - 1)
    return np.where(filled, ((32 - exponent).astype(np.uint64) << np.uint64(MANTISSA)) | mantissa, _EMPTY).astype(np.uint16)


#: By bucket, the order in which it looks for a filled one.
_LENDERS = np.array([np.random.default_rng(4410 + i).permutation(BUCKETS) for i in range(BUCKETS)])


def densify(registers: np.ndarray) -> np.ndarray:
    """Rows of registers with the empty ones borrowed; a row without any stays empty."""
    out = registers.copy()
    rows, cols = np.nonzero(out == _EMPTY)
    for turn in range(BUCKETS):
        if not len(rows):
            break
        found = registers[rows, _LENDERS[cols, turn]]
        out[rows, cols] = found
        still = found == _EMPTY
        rows, cols = rows[still], cols[still]
    return out


def bands(registers: np.ndarray) -> np.ndarray:
    """Hash of each band; the number of a band is part of its hash."""
    keys = densify(registers[None])[0].reshape(-1, ROWS).astype(np.uint64)
    acc = np.arange(1, len(keys) + 1, dtype=np.uint64)
    for j in range(ROWS):
        acc = mix(acc * np.uint64(0x2545F4914F6CDD1D) + keys[:, j] + np.uint64(1))
    return acc.view(np.int64)


@lru_cache
def collisions(most: int = 28) -> np.ndarray:
    """Chance that unequal minima of two buckets share a register, by the log2 of the buckets' mean set sizes.

    Sums over all registers the product of the chances that each minimum falls into its interval.
    """
    zeros = np.arange(33)[:, None]
    low = np.concatenate([(2.0 ** -(zeros[:-1] + 1)) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)), np.zeros((1, 1 << MANTISSA))])
    width = np.concatenate([np.repeat(2.0 ** -(zeros[:-1] + 1 + MANTISSA), 1 << MANTISSA, axis=1), np.full((1, 1 << MANTISSA), 2.0 ** -(32 + MANTISSA))])
    inside = []
    for size in range(most):
        n = 2.0**size
        inside.append((np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(low + width, 1 - 1e-16)))).ravel())
    grid = np.array(inside)
    return grid @ grid.T


def estimate(matches: np.ndarray, filled: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from register matches among ``filled`` buckets, corrected for collisions of sets of these sizes."""
    table_ = collisions()
    at = [np.clip(np.round(np.log2(np.maximum(n, 1) / BUCKETS)), 0, len(table_) - 1).astype(int) for n in (n_a, n_b)]
    chance = table_[at[0], at[1]]
    return (matches / np.maximum(filled, 1) - chance) / (1 - chance)


@lru_cache
def least_matches(similarity: float) -> np.ndarray:
    """By filled buckets, the matches that a pair of this similarity has but with probability MISS (Chernoff bound)."""
    out = np.zeros(BUCKETS + 1, dtype=np.int16)
    for n in range(1, BUCKETS + 1):
        for k in range(int(similarity * n), 0, -1):
            q = k / n
            far = q * math.log(q / similarity) + ((1 - q) * math.log((1 - q) / (1 - similarity)) if q < 1 else 0)
            if math.exp(-n * far) <= MISS:
                out[n] = k
                break
    return out


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            out: dict[str, list] = {"id": batch.column("id"), "n": [], "f1": [], "f2": [], "regs": [], "keys": []}
            for text in texts(batch.column("text")):
                s = shingle_set(text, width)
                some = len(s) > 0
                regs = sketch(s) if some else None
                out["n"].append(len(s))
                out["f1"].append(int(np.add.reduce(mix(s)).view(np.int64)) if some else 0)
                out["f2"].append(int(np.bitwise_xor.reduce(mix(s + np.uint64(77))).view(np.int64)) if some else 0)
                out["regs"].append(regs.tobytes() if some else None)
                out["keys"].append(bands(regs) if some else None)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([out["id"], *(pa.array(out[c], k) for c, k in zip(("n", "f1", "f2", "regs", "keys"), kinds))], names=list(out))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            found = [shingle_set(t, width) for t in texts(batch.column("text"))]
            # rows that share an id may have other sets than the node's
            right = [i for i, (s, f) in enumerate(zip(found, batch.column("f1").to_pylist())) if int(np.add.reduce(mix(s)).view(np.int64)) == f]
            kept = batch.take(pa.array(right, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("node"), kept.column("n"), kept.column("regs"), pa.array([found[i].view(np.int64) for i in right], pa.list_(pa.int64()))], names=["id", "n", "regs", "shingles"])

    return run


def _matches(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal registers of each pair, and the buckets that either fills."""
    fa, fb = a != _EMPTY, b != _EMPTY
    other = np.where(fb, b, np.uint16(_EMPTY - 1))  # two empty registers are no match
    out = np.empty((len(a), len(b)), dtype=np.int16)
    for i in range(len(a)):
        out[i] = (other == a[i]).sum(axis=1)
    both = fa.astype(np.float32) @ fb.astype(np.float32).T
    return out, (fa.sum(axis=1)[:, None] + fb.sum(axis=1)[None, :] - both).astype(np.int16)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of equal keys of a sorted stream, as numpy columns; a run may span batches."""
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch])
        if carry is not None:
            held = pa.concat_tables([carry, held])
        change = np.zeros(held.num_rows - 1, dtype=bool)
        for k in keys:
            column = held.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(change) + 1))
        yield from _cut(held.slice(0, int(cuts[-1])), cuts)
        carry = held.slice(int(cuts[-1]))
    if carry is not None and carry.num_rows:
        yield from _cut(carry, np.array([0, carry.num_rows]))


def _cut(held: pa.Table, cuts: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    if held.num_rows:
        columns = {c: held.column(c).to_numpy() for c in held.column_names if c != "regs"}
        columns["regs"] = np.frombuffer(b"".join(held.column("regs").to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield {c: x[a:b] for c, x in columns.items()}


def _rows(parts_: list[np.ndarray], names: list[str], kinds: list) -> pa.RecordBatch:
    whole = np.concatenate(parts_, axis=1) if parts_ else np.zeros((len(names), 0))
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(whole, kinds)], names=names)


def _propose(threshold: float):
    """Of each tile: for each class its best partner, and its best among those before it.

    Estimates travel in millionths, so that all columns are whole numbers.
    """
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["u", "a", "b", "score", "kind"], [pa.int64()] * 4 + [pa.int32()]
        out: list[np.ndarray] = []
        for group in _groups(batches, ["bucket", "tile"]):
            ids, where = np.unique(group["id"], return_index=True)
            if len(ids) < 2:
                continue
            order = np.argsort(mix(ids.view(np.uint64)))
            ids, where = ids[order], where[order]
            regs, n = group["regs"][where], group["n"][where]
            matches, filled = _matches(regs, regs)
            score = np.where(matches >= np.maximum(least[filled], 1), (1e6 * estimate(matches, filled, n[:, None], n[None, :])).astype(np.int64), -1)
            np.fill_diagonal(score, -1)
            for kind, grid in enumerate((score, np.where(np.tri(len(ids), k=-1, dtype=bool), score, -1))):
                best = grid.argmax(axis=1)
                got = grid[np.arange(len(ids)), best]
                ok = got >= 0
                u, v = ids[ok], ids[best[ok]]
                out.append(np.stack([u, np.minimum(u, v), np.maximum(u, v), got[ok], np.full(len(u), kind)]))
            if len(out) > 2000:
                yield _rows(out, names, kinds)
                out = []
        yield _rows(out, names, kinds)

    return run


def _near_pairs(group: dict[str, np.ndarray], least: np.ndarray, comp: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a pair of tiles with those of the other side that may be linked with them, judged by registers.

    A pair is looked at in the first band that it shares, and only while its components in ``comp`` differ.
    """
    side = group["side"]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    if not len(left) or not len(right) or (comp == comp[0]).all():
        return
    a, b = group["regs"][left], group["regs"][right]
    matches, filled = _matches(a, b)
    near = (matches >= np.maximum(least[filled], 1)) & (comp[left][:, None] != comp[right][None, :])
    if side[0] == 2:
        near &= left[:, None] < right[None, :]
    a4, b4 = (densify(x).reshape(len(x), -1, ROWS) for x in (a, b))
    band = int(np.flatnonzero(bands(a[0]) == group["bucket"][0])[0])
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        j = np.flatnonzero(near[i])
        j = j[comp[right[j]] != comp[left[i]]]
        j = j[(a4[i] == b4[j]).all(axis=2).argmax(axis=1) == band]
        if len(j):
            yield left[i], right[j]


def _reach(threshold: float):
    """Of each pair of tiles: the rows with such partners, without sets; the others need not travel with theirs."""
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = list(_PLACE), [pa.int64() if k == "long" else pa.int32() for k in _PLACE.values()]
        out, held = [], 0
        for group in _groups(batches, _TILES):
            hit = np.zeros(len(group["id"]), dtype=bool)
            for i, j in _near_pairs(group, least, group["component"]):
                hit[i] = hit[j] = True
            if hit.any():
                out.append(np.stack([group[c][hit].astype(np.int64) for c in names]))
                held += int(hit.sum())
            if held > 50_000:
                yield _rows(out, names, kinds)
                out, held = [], 0
        yield _rows(out, names, kinds)

    return run


def _cross(threshold: float):
    """Of each pair of tiles: links between components, decided on full sets.

    Once two components are linked here, further pairs of theirs add nothing and are not worked out.
    """
    least = least_matches(threshold)
    share = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["a", "b"], [pa.int64()] * 2
        out: list[tuple[int, int]] = []
        for group in _groups(batches, _TILES):
            ids, sets, comp = group["id"], group["shingles"], group["component"].copy()
            for i, js in _near_pairs(group, least, comp):
                mine = sets[i].view(np.uint64)
                theirs = [sets[k].view(np.uint64) for k in js]
                sizes = np.array([len(x) for x in theirs])
                whole = np.concatenate(theirs)
                hit = mine[np.minimum(np.searchsorted(mine, whole), len(mine) - 1)] == whole
                both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                for k in js[100 * both >= share * (len(mine) + sizes - both)].tolist():
                    x, y = comp[i], comp[k]
                    if x != y:
                        comp[comp == y] = x
                        out.append((ids[i], ids[k]))
            if len(out) > 50_000:
                yield _rows([np.array(out).T], names, kinds)
                out = []
        yield _rows([np.array(out).T] if out else [], names, kinds)

    return run


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    two = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    both = F.size(F.array_intersect("sa", "sb"))
    share = round(threshold * 100)
    return pairs.join(one, "b").join(two, "a").where(100 * both >= share * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _salt(column: str):
    return F.pmod(F.xxhash64(column, F.lit(5)), F.lit(SALTS)).cast("int")


def _all_salts(rows: DataFrame) -> DataFrame:
    """One row for each salt, so that a hot key's partners are dealt over tasks."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _tile(size: str, salt: int):
    return F.expr(f"cast(pmod(xxhash64(id, {salt}), greatest(1, ceil({size} / {TILE}))) as int)")


def _tiles(size: str):
    return F.expr(f"sequence(0, cast(greatest(1, ceil({size} / {TILE})) as int) - 1)")


def _open_tiles(known: DataFrame) -> DataFrame:
    """(id, bucket, component, inner, t1, t2, side) of the pairs of tiles that may hold links between components.

    ``inner`` 0: largest component (side 0) against the others (side 1); 1: the others among themselves.
    """
    shares = known.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    buckets = shares.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("main")).where("parts > 1")
    facts = _all_salts(buckets.select("bucket", F.col("main.component").alias("main"), F.col("main.n").alias("inside"), (F.col("size") - F.col("main.n")).alias("outside")))
    left = known.withColumn("salt", _salt("id")).join(facts, ["bucket", "salt"])
    is_main = F.col("component") == F.col("main")
    grid = left.withColumns({"mine": F.when(is_main, _tile("inside", 7)).otherwise(_tile("outside", 7)), "across": F.explode(F.when(is_main, _tiles("outside")).otherwise(_tiles("inside")))})
    grid = grid.select("id", "bucket", "component", F.lit(0).alias("inner"), F.when(is_main, F.col("mine")).otherwise(F.col("across")).alias("t1"), F.when(is_main, F.col("across")).otherwise(F.col("mine")).alias("t2"), F.when(is_main, 0).otherwise(1).alias("side"))
    rest = left.where(~is_main & (F.col("outside") > 1)).withColumns({"tile": _tile("outside", 7), "other": F.explode(_tiles("outside"))})
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    return grid.union(rest.select("id", "bucket", "component", F.lit(1), F.least("tile", "other"), F.greatest("tile", "other"), side))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, threshold: float = 0.8) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_class, kept)``, one row per row of ``docs``.

    ``n_class`` counts the distinct documents with the same set.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    signed = materialise(rows.mapInArrow(_signatures(width), "id long, n long, f1 long, f2 long, regs binary, keys array<long>"))
    short = signed.where("id is not null and n > 0").select("id", "n", "f1", "f2").distinct()
    # a node is a document; further sets of one document are nodes of their own
    same = Window.partitionBy("id")
    turn = F.row_number().over(same.orderBy("n", "f1", "f2"))
    nodes = materialise(short.withColumn("node", F.when(turn == 1, F.col("id")).otherwise(F.xxhash64("id", "n", "f1", "f2"))).withColumn("sets", F.count("*").over(same)))
    several = bool(nodes.where("sets > 1").take(1))
    classes = materialise(nodes.groupBy("n", "f1", "f2").agg(F.min(F.struct("id", "node")).alias("first"), F.count("*").alias("n_class")).select("n", "f1", "f2", F.col("first.id").alias("id"), F.col("first.node").alias("node"), "n_class"))
    reps = signed.where("n > 0").join(classes.select("id", "n", "f1", "f2", "node"), ["id", "n", "f1", "f2"]).dropDuplicates(["node"])

    buckets = reps.select(F.col("node").alias("id"), F.explode("keys").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(buckets.withColumn("salt", _salt("id")).join(_all_salts(shared), ["bucket", "salt"]).drop("salt"))
    wanted = reps.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select("id", "node", "n", "f1", "regs")
    near = materialise(rows.join(wanted, "id").select("node", "n", "regs", "f1", "text").mapInArrow(_sets(width), "id long, n long, regs binary, shingles array<long>").dropDuplicates(["id"]))
    dealt = members.join(near.select("id", "n", "regs"), "id").withColumn("tile", _tile("size", 7)).select("bucket", "tile", "id", "n", "regs")
    found = dealt.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile").mapInArrow(_propose(threshold), "u long, a long, b long, score long, kind int")
    first = found.groupBy("u", "kind").agg(F.max(F.struct("score", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
    links = _verified(first, near, threshold)
    if several:
        links = links.union(nodes.where("sets > 1").join(classes.select("n", "f1", "f2", F.col("node").alias("rep")), ["n", "f1", "f2"]).where("rep <> id").select("rep", "id"))
    links = materialise(links)
    label = components(links)

    known = materialise(members.select("id", "bucket").join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    spread = _open_tiles(known)
    dealt = spread.join(near.select("id", "regs"), "id").repartition(*_TILES).sortWithinPartitions(*_TILES)
    reached = dealt.mapInArrow(_reach(threshold), ", ".join(f"{c} {k}" for c, k in _PLACE.items()))
    dealt = reached.join(near.select("id", "regs", "shingles"), "id").repartition(*_TILES).sortWithinPartitions(*_TILES)
    label = components(links.union(materialise(dealt.mapInArrow(_cross(threshold), "a long, b long"))))

    placed = nodes.join(classes.select("n", "f1", "f2", F.col("node").alias("rep"), "n_class"), ["n", "f1", "f2"]).join(label.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.select("id", "n", "f1", "f2", "n_class", F.coalesce("component", "rep").alias("label"))
    if several:
        # a label may be the number of a further set: the least id names the component
        odd = placed.join(nodes.where("sets > 1 and node <> id").select(F.col("node").alias("label")), "label", "left_semi").groupBy("label").agg(F.min("id").alias("least"))
        placed = placed.join(odd, "label", "left").withColumn("label", F.coalesce("least", "label")).drop("least")
    result = signed.select("id", "n", "f1", "f2").join(placed, ["id", "n", "f1", "f2"], "left")
    component = F.coalesce("label", "id")
    return result.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies the document with the least id stays.

    Rows without an id and texts without words stay; rows that share an id go or stay together.
    """
    found = near_duplicates(docs, width=5)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
