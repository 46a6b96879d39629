"""Nearest neighbours by cosine with vantage-point trees, one for each shard.

On unit vectors the distance sqrt(2 - 2 cos) is a metric.  Centres fitted on a
bounded sample deal the vectors into cells; a cell of over ``SHARD_ROWS``
vectors is split by a hash.  Each shard builds a vantage-point tree: a node's
points are halved by their distance from a vantage point, and each half keeps
its least and largest distance.  A query first searches its own cell; the radius
it got there decides which other cells it has to visit, by their distances from
their centres and from the bisecting planes, and inside a shard which halves.
What lies at a distance of at least ``bound`` is left out if ``bound * factor``
exceeds the radius: with factor one that is the triangle inequality and the
search exact, a larger factor visits less and may miss some.  Vectors without
structure leave little to prune; then work grows with queries times vectors, in blocks.

Equal vectors are one point that carries its ``k`` + 1 smallest ids, picked
before the shuffle, so a hot group of copies costs one point; no more of them
can be among the nearest of any query.  Every row is in the index.  Tasks get a
shard and at most about ``QUERY_ROWS`` of its queries.

Defined cases: vectors that are null, empty, zero or hold nulls or non-finite
components take no part, nor do rows without id; vectors of other length than
the query's aren't compared with it; rows of equal id and vector count once,
other rows of the query's id are its own and no answers; ties go to the smaller
id; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import materialise, parts, table

NEAREST = 5
#: The query keeps the search exact.  Factor two found 0.995 and 0.999 of the neighbours on two of the given tables.
FACTOR = 1.0
SHARD_ROWS, QUERY_ROWS, LEAF = 8192, 8192, 128
#: Vectors on which centres are fitted, and most centres; both bound what the driver holds.
SAMPLE, MOST_CELLS = 16_384, 1024
#: Slack of distances computed in double precision.
SLACK = 1e-7
#: Queries that a shard searches at a time.
BATCH = 2048

_RESULT = "query_id long, query_hash long, own_cell boolean, vec_id long, score double, radius double"


# --- vectors


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as doubles, each scaled by a power of two, which changes no cosine but keeps squares in range."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = flat.reshape(len(column), -1)
    _, power = np.frexp(np.abs(rows).max(axis=1, initial=0))
    return np.ldexp(rows, -power[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows, each by itself, so that it doesn't depend on what else is in the batch."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def fitted_centres(rows: np.ndarray, cells: int, rounds: int = 6) -> np.ndarray:
    """Centres of unit vectors by a few rounds of k-means from spread-out starts."""
    cells = min(cells, len(rows))
    step = max(1, len(rows) // cells)
    centres = rows[::step][:cells].copy()
    for _ in range(rounds if cells > 1 else 1):
        nearest = np.argmin((centres * centres).sum(axis=1) - 2 * rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        held = np.bincount(nearest, minlength=cells)
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def to_centres(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * rows @ centres.T
    return np.sqrt(np.maximum(0.0, square))


# --- the tree of one shard


class VantageTree:
    """Unit vectors ``points`` with ids ``names`` in a tree; ``search`` finds the ``k`` of largest cosine, ties to smaller names."""

    def __init__(self, points: np.ndarray, names: np.ndarray, leaf: int = LEAF):
        order = np.argsort(names, kind="stable")
        self.points, self.names, self.place = points[order], names[order], order
        self.nodes: list[tuple] = []
        self.visited = 0
        self.root = self._built(np.arange(len(points)), leaf)

    def _built(self, at: np.ndarray, leaf: int) -> int:
        node = len(self.nodes)
        self.nodes.append(())
        if len(at) <= leaf:
            self.nodes[node] = (None, np.sort(at))
            return node
        # of a few points the one whose distances differ most
        tried = at[:: max(1, len(at) // 5)][:5]
        far = distance(self.points[tried] @ self.points[at[:: max(1, len(at) // 256)]].T)
        vantage = self.points[tried[int(np.argmax(far.var(axis=1)))]]
        d = distance(self.points[at] @ vantage)
        order = np.argsort(d, kind="stable")
        half = len(at) // 2
        inner, outer = order[:half], order[half:]
        bounds = (d[inner[0]], d[inner[-1]], d[outer[0]], d[outer[-1]])
        self.nodes[node] = (vantage, bounds, self._built(at[inner], leaf), self._built(at[outer], leaf))
        return node

    def search(self, queries: np.ndarray, k: int, radius: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines), best first; place -1 where fewer were found."""
        self.q, self.k, self.factor = queries, k, factor
        self.radius = radius.copy()
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1)
        self._visit(self.root, np.arange(len(queries)))
        return np.where(self.found >= 0, self.place[self.found], -1), self.best

    def _visit(self, node: int, who: np.ndarray) -> None:
        if not len(who):
            return
        vantage, *rest = self.nodes[node]
        if vantage is None:
            self._compare(rest[0], who)
            return
        (low_in, high_in, low_out, high_out), inner, outer = rest
        d = distance(self.q[who] @ vantage)
        bound_in = np.maximum(np.maximum(low_in - d, d - high_in), 0) * self.factor - SLACK
        bound_out = np.maximum(np.maximum(low_out - d, d - high_out), 0) * self.factor - SLACK
        near_in = bound_in <= bound_out
        for side, ways in ((near_in, ((inner, bound_in), (outer, bound_out))), (~near_in, ((outer, bound_out), (inner, bound_in)))):
            for child, bound in ways:
                self._visit(child, who[side & (bound <= self.radius[who])])

    def _compare(self, at: np.ndarray, who: np.ndarray) -> None:
        self.visited += len(at) * len(who)
        scores = self.q[who] @ self.points[at].T
        # a tie with the worst held may still win by its name
        better = (scores >= self.best[who, -1][:, None]).any(axis=1)
        if not better.any():
            return
        who, scores = who[better], scores[better]
        all_scores = np.concatenate([self.best[who], scores], axis=1)
        all_at = np.concatenate([self.found[who], np.broadcast_to(at, scores.shape)], axis=1)
        # places are in the order of names
        order = np.lexsort((all_at, -all_scores), axis=1)[:, : self.k]
        self.best[who] = np.take_along_axis(all_scores, order, axis=1)
        self.found[who] = np.take_along_axis(all_at, order, axis=1)
        worst = self.best[who, -1]
        self.radius[who] = np.minimum(self.radius[who], np.where(np.isfinite(worst), distance(np.where(np.isfinite(worst), worst, 0)), np.inf))


# --- tasks


def _searcher(k: int, factor: float, own_cell: bool) -> Callable:
    def answers(tree: VantageTree, rows: np.ndarray, ids: list, batch: pa.RecordBatch) -> pa.RecordBatch:
        asked = matrix(batch.column("v"))
        radius = np.asarray(batch.column("radius").to_numpy(zero_copy_only=False), dtype=np.float64)
        # its own row may be among them, and what rounding could swap
        places, _ = tree.search(unit(asked), k + 3, radius, factor)
        out: tuple = ([], [], [], [], [])
        for j, (query, key) in enumerate(zip((x[0] for x in batch.column("ids").to_pylist()), batch.column("hash").to_pylist(), strict=True)):
            at = places[j][places[j] >= 0]
            scores = cosine(asked[j][None, :], rows[at])
            best = sorted((-s, i) for s, a in zip(scores.tolist(), at.tolist(), strict=True) for i in ids[a] if i != query)[:k]
            reach = float(distance(np.float64(-best[-1][0]))) if len(best) == k else float("inf")
            for s, i in best:
                for column, x in zip(out, (query, key, i, -s, reach), strict=True):
                    column.append(x)
        query_id, key, vec_id, score, reach = out
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((query_id, key, [own_cell] * len(score), vec_id, score, reach), kinds, strict=True)], names=[x.split()[0] for x in _RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_now, shard, tree, rows, ids = None, [], None, None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "cell", "salt", "block", "kind")), strict=True))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at][:4] != unit_now:
                    unit_now, shard, tree = keys[at][:4], [], None
                piece = batch.slice(at, end - at)
                if keys[at][4] == 0:
                    shard.append(piece.select(["ids", "v"]))
                elif shard or tree is not None:
                    if tree is None:
                        rows = np.concatenate([matrix(p.column("v")) for p in shard])
                        ids = [x for p in shard for x in p.column("ids").to_pylist()]
                        tree, shard = VantageTree(unit(rows), np.array([x[0] for x in ids])), []
                    for b in range(0, piece.num_rows, BATCH):
                        yield answers(tree, rows, ids, piece.slice(b, BATCH))
                at = end
        return

    return run


def _assigner(centres: dict[int, np.ndarray]) -> Callable:
    """Cell and distance from its centre for each vector; lengths without centres are one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                if dim in centres:
                    at = np.flatnonzero(dims == dim)
                    d = to_centres(unit(matrix(batch.column("v").take(pa.array(at)))), centres[dim])
                    cell[at] = d.argmin(axis=1)
                    far[at] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return run


def _router(centres: dict[int, np.ndarray], reach: dict[int, tuple[np.ndarray, np.ndarray]], factor: float) -> Callable:
    """One row for each other cell that may hold something within a query's radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                if dim not in centres or len(centres[dim]) < 2:
                    continue
                at = np.flatnonzero(dims == dim)
                piece = batch.take(pa.array(at))
                d, (low, high) = to_centres(unit(matrix(piece.column("v"))), centres[dim]), reach[dim]
                own = piece.column("cell").to_numpy(zero_copy_only=False)
                here = d[np.arange(len(at)), own][:, None]
                apart = to_centres(centres[dim], centres[dim])[own]
                # from the shell that holds the cell, and from the plane halfway between the centres
                plane = (d * d - here * here) / np.maximum(2 * apart, 1e-12)
                bound = np.maximum(np.maximum(low - d, d - high), np.maximum(plane, 0))
                radius = np.asarray(piece.column("radius").to_numpy(zero_copy_only=False), dtype=np.float64)[:, None]
                go = bound * factor - SLACK <= radius
                go[np.arange(len(at)), own] = False
                row, cell = np.nonzero(go & (high >= 0))
                for b in range(0, len(row), 8192):
                    routed = piece.take(pa.array(row[b : b + 8192]))
                    yield routed.set_column(routed.schema.get_field_index("cell"), "cell", pa.array(cell[b : b + 8192], pa.int64()))

    return run


# --- frames


def valid(column: str) -> Column:
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def points(vectors: DataFrame, k: int) -> DataFrame:
    """``(v, ids)``: each different vector with its ``k`` + 1 smallest ids; a window limit drops the rest before the shuffle."""
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    return vectors.select("v", "vec_id").withColumn("_place", place).where(F.col("_place") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _search(queries: DataFrame, shards: DataFrame, cells: DataFrame, k: int, factor: float, own_cell: bool) -> DataFrame:
    """Each query in all shards of its cell.  A cell's vectors go to each block of its queries, its queries to each of its shards."""
    asked = queries.groupBy("dim", "cell").agg(F.count("*").alias("asked"))
    plan = cells.join(asked, ["dim", "cell"]).select("dim", "cell", F.ceil(F.col("held") / SHARD_ROWS).alias("salts"), F.ceil(F.col("asked") / QUERY_ROWS).alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["dim", "cell", "salt", "block", "kind", "ids", "hash", "v", "radius"]
    held = shards.join(plan, ["dim", "cell"]).withColumn("salt", F.pmod("hash", F.col("salts"))).withColumn("block", each("blocks")).withColumn("kind", F.lit(0)).withColumn("radius", F.lit(0.0))
    sent = queries.join(plan, ["dim", "cell"]).withColumn("block", F.pmod("hash", F.col("blocks"))).withColumn("salt", each("salts")).withColumn("kind", F.lit(1))
    key = ["dim", "cell", "salt", "block"]
    both = held.select(columns).unionByName(sent.select(columns)).repartition(parts(shards.sparkSession), *key).sortWithinPartitions(*key, "kind")
    return both.mapInArrow(_searcher(k, factor, own_cell), _RESULT)


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row that ``queries`` (on ``vec_id``) names."""
    spark = vectors.sparkSession
    rows = vectors.where(valid(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    counts = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(16).collect()
    centres: dict[int, np.ndarray] = {}
    for dim, n in counts:
        cells = min(MOST_CELLS, -(-n // SHARD_ROWS))
        if cells > 1:
            sample = rows.where(F.size("v") == dim).select("v", F.md5(F.col("vec_id").cast("string").cast("binary")).alias("order")).orderBy("order").limit(SAMPLE).select("v").toArrow()
            centres[dim] = fitted_centres(unit(matrix(sample.column("v"))), cells)
    kind = dict(rows.dtypes)["v"]
    assigned = f"ids array<bigint>, v {kind}, hash bigint, dim bigint, cell bigint, far double"
    marked = lambda df: df.select("ids", "v", F.xxhash64("v").alias("hash"), F.size("v").cast("long").alias("dim"))
    shards = materialise(marked(points(rows, k)).mapInArrow(_assigner(centres), assigned))
    cells = materialise(shards.groupBy("dim", "cell").agg(F.count("*").alias("held"), F.min("far").alias("low"), F.max("far").alias("high")))
    reach: dict[int, tuple[np.ndarray, np.ndarray]] = {d: (np.zeros(len(c)), np.full(len(c), -1.0)) for d, c in centres.items()}
    for r in cells.where(F.col("dim").isin(*centres)).collect() if centres else []:
        reach[r.dim][0][r.cell], reach[r.dim][1][r.cell] = r.low, r.high

    asking = rows.where(queries).select(F.array("vec_id").alias("ids"), "v").dropDuplicates()
    asking = materialise(marked(asking).mapInArrow(_assigner(centres), assigned).drop("far").withColumn("radius", F.lit(float("inf"))))
    found = _search(asking, shards, cells, k, factor, True)
    if centres:
        found = materialise(found)
        first = found.groupBy(F.col("query_id"), F.col("query_hash").alias("hash")).agg(F.min("radius").alias("reach"))
        known = asking.withColumn("query_id", F.col("ids")[0]).join(first, ["query_id", "hash"], "left").withColumn("radius", F.coalesce("reach", "radius"))
        wanted = known.select("ids", "v", "hash", "dim", "cell", "radius")
        routed = materialise(wanted.mapInArrow(_router(centres, reach, factor), f"ids array<bigint>, v {kind}, hash bigint, dim bigint, cell bigint, radius double"))
        found = found.unionByName(_search(routed, shards, cells, k, factor, False))
    place = F.row_number().over(Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", "query_hash", "vec_id", "score").withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH kept AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, q.v, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM kept q JOIN kept c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
), ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""
