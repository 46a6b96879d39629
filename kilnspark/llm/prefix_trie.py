"""Trie of shared conversation prefixes.

A prefix's digest is the running sum of hashes of (place, role, text): four
lanes of 32 bits, summed as longs, so that a long conversation may be cut into
ranges and its sums joined again.  A node belongs to its smallest member, and
whoever owns a prefix owns all longer ones of its own: each conversation's
owned depths are a chain that begins at its first owned depth.  That depth is
found by binary search: in each round all open conversations ask for their
middle depth, in one join, against the minima of the prefix digests.  The last
depth that was someone else's gives the chain's parent.  Chains are then
aggregated from the bottom up: in each round those whose children are all done
hand their totals to their parents.  One pass of running sums along the chains
gives every node its own figures.

Work is linear in the turns but for the logarithm of the longest conversation
(rounds of the search) and the height of the tree of chains (rounds of the
aggregation; a chain begins deeper than its parent, so it is bounded by the
longest conversation).  Digests with many members, at most ``HOT`` of them by
their counts, are asked by broadcast.  No text takes part after its hash.

Defined cases: null turns come first, turns of equal number are ordered by role
and text; null roles and texts are empty; rows without conversation id belong to
no conversation; conversations rebuilt without turns are members of the root
alone; the remainder that picks a head has the sign of its id; an empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import materialise, parts, table

FAMILY, HEADS = 5, 9
#: A digest is hot if it has over one in so many of all prefixes, which bounds the hot ones.
HOT = 2000
#: Characters of ids that one chunk carries to the hash of its node.
CHUNK = 1 << 18

_LANES = ["d0", "d1", "d2", "d3"]
_DIGEST = ["depth", *_LANES]
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


# --- running sums along groups that may be cut into ranges


def _accumulator(by: str, values: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, dict.fromkeys(values, 0)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(by).to_numpy(zero_copy_only=False)
            begins = np.r_[True, ids[1:] != ids[:-1]]
            first, group = np.flatnonzero(begins), np.cumsum(begins) - 1
            columns = [batch.column(c) for c in batch.schema.names if c not in values]
            names = [c for c in batch.schema.names if c not in values]
            for v in values:
                each = batch.column(v).to_numpy(zero_copy_only=False)
                total = np.cumsum(each)
                base = (total - each)[first]
                if ids[0] == last:
                    base[0] -= carried[v]
                total -= base[group]
                carried[v] = int(total[-1])
                columns.append(pa.array(total, pa.int64()))
                names.append(v)
            last = ids[-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(ids), part), pa.int64())], names=[*names, "_part"])

    return run


def running(df: DataFrame, by: str, order: list[Column], values: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and, under their names, the running sums of the long columns ``values`` over each group ``by`` (long) in that order.

    Rows are dealt by ranges of (``by``, ``order``); a range sums what it has, and
    groups cut between ranges get the sums of the ranges before, which are at most two for a range.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(parts(spark), F.col(by), *order).sortWithinPartitions(F.col(by), *order).select(*keep, *values)
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keep), *(f"{v} long" for v in values), "_part long"])
    local = materialise(dealt.mapInArrow(_accumulator(by, values), schema))
    edges = local.groupBy("_part").agg(F.min(by).alias("lo"), F.max(by).alias("hi"))
    cut = edges.select("_part", F.explode(F.array_distinct(F.array("lo", "hi"))).alias(by)).groupBy(by).agg(F.count("*").alias("_n")).where("_n > 1").select(by)
    # sums of counts and hashes grow along a group, so the last is the largest
    ends = local.join(F.broadcast(cut), by).groupBy(by, "_part").agg(*[F.max(v).alias(f"_{v}") for v in values])
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(by, "_part", *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values])
    out = local.join(F.broadcast(offsets), [by, "_part"], "left")
    return out.select(*keep, *[(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in values])


# --- conversations and their prefixes


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, key, bytes, pos)``: each turn's hash of role and text, size of its text and place from 1."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text")).where(F.col("conv_id").isNotNull())
    key = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = rows.withColumn("key", key).withColumn("bytes", F.octet_length("text").cast("long")).withColumn("pos", F.lit(1).cast("long"))
    return running(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["pos"], ["conv_id", "key", "bytes"])


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ids, turns): all conversations, and ``(conv_id, depth, key, bytes)`` of their rebuilt turns."""
    ids = numbered.groupBy("conv_id").agg(F.max("pos").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = ids.withColumn("head", head).withColumn("base", base)
    sizes = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    ids = materialise(ids.join(sizes, "base", "left").withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0)))).select("conv_id", "head", "base", "taken"))
    own = numbered.join(ids, "conv_id").where(F.col("pos") > F.col("head")).select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "key", "bytes")
    heads = numbered.where(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base").join(ids, "base").where(F.col("pos") <= F.col("taken"))
    return ids.select("conv_id"), heads.select("conv_id", F.col("pos").alias("depth"), "key", "bytes").unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, bytes, d0..d3, cum)`` of each prefix: its last text's bytes, digest, bytes of all its texts."""
    mixed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("key")).cast("binary"))
    rows = turns.withColumn("_h", mixed)
    for k, lane in enumerate(_LANES):
        rows = rows.withColumn(lane, F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("long"))
    rows = rows.withColumn("cum", F.col("bytes")).drop("_h", "key")
    return running(rows, "conv_id", [F.col("depth")], [*_LANES, "cum"], ["conv_id", "depth", "bytes"])


# --- first owned depths


def _owners(asks: DataFrame, minima: DataFrame, hot: DataFrame) -> DataFrame:
    """``asks`` with the ``owner`` of its digest; every asked digest has one."""
    tried = asks.join(F.broadcast(hot.select(*_DIGEST, F.col("owner").alias("_hot"))), _DIGEST, "left")
    found = tried.where(F.col("_hot").isNotNull()).withColumn("owner", F.col("_hot"))
    rest = tried.where(F.col("_hot").isNull()).join(minima.select(*_DIGEST, "owner"), _DIGEST)
    return found.drop("_hot", *_LANES).unionByName(rest.drop("_hot", *_LANES))


def first_owned(ids: DataFrame, steps: DataFrame, root: int, longest: int) -> DataFrame:
    """``(conv_id, n_turns, total, first, below, below_cum)``: owned from ``first`` on (``n_turns`` + 1: nothing); ``below`` owns the depth before."""
    minima = materialise(steps.groupBy(*_DIGEST).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n")))
    prefixes_in_all = minima.agg(F.sum("n")).first()[0] or 0
    hot = minima.where(F.col("n") * HOT > prefixes_in_all)
    sizes = steps.groupBy("conv_id").agg(F.max("depth").alias("n_turns"), F.max("cum").alias("total"))
    start = ids.join(sizes, "conv_id", "left").select("conv_id", F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("total", F.lit(0)).alias("total"))
    state = start.withColumn("lo", F.lit(1).cast("long")).withColumn("hi", F.col("n_turns") + 1).withColumn("below", F.lit(root).cast("long")).withColumn("below_cum", F.lit(0).cast("long"))
    state, settled = materialise(state), []
    for _ in range(math.ceil(math.log2(longest + 1)) if longest else 0):
        settled.append(state.where("lo >= hi"))
        asks = state.where("lo < hi").withColumn("depth", F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")).join(steps.select("conv_id", *_DIGEST, "cum"), ["conv_id", "depth"])
        asked = _owners(asks, minima, hot)
        owns, mid = F.col("owner") == F.col("conv_id"), F.col("depth")
        state = materialise(asked.select("conv_id", "n_turns", "total", F.when(owns, F.col("lo")).otherwise(mid + 1).alias("lo"), F.when(owns, mid).otherwise(F.col("hi")).alias("hi"), F.when(owns, F.col("below")).otherwise(F.col("owner")).alias("below"), F.when(owns, F.col("below_cum")).otherwise(F.col("cum")).alias("below_cum")))
    found = reduce(DataFrame.unionByName, [*settled, state])
    return found.select("conv_id", "n_turns", "total", F.col("lo").alias("first"), "below", "below_cum")


# --- chains, bottom up


_SUMS = ["n", "leaves", "total", "own"]


def chain_totals(chains: DataFrame) -> DataFrame:
    """Each chain's figures with those of all chains below it.

    ``chains``: ``(conv_id, parent, attach, n, leaves, total, own)``.  A round settles
    the chains without open children; sums go to parents after a partial aggregate,
    and every join is by a unique chain.
    """
    children = chains.groupBy(F.col("parent").alias("conv_id")).agg(F.count("*").alias("open"))
    live = materialise(chains.join(children, "conv_id", "left").fillna(0, ["open"]))
    done = []
    while not live.isEmpty():
        ready = live.where("open = 0")
        done.append(ready)
        given = ready.groupBy(F.col("parent").alias("conv_id")).agg(F.count("*").alias("_open"), *[F.sum(c).alias(f"_{c}") for c in _SUMS])
        rest = live.where("open > 0").join(given, "conv_id", "left").fillna(0)
        live = materialise(rest.select("conv_id", "parent", "attach", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in _SUMS], (F.col("open") - F.col("_open")).alias("open")))
    return reduce(DataFrame.unionByName, done).drop("open") if done else live.drop("open")


# --- hashes of the conversations that end at a node


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "depth", "least", "chunk"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    rows: list[tuple] = []
    key, ids, size, held = None, [], 0, 0
    for batch in batches:
        for owner, depth, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (owner, depth) or size > CHUNK:
                if ids:
                    rows.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids, size = (owner, depth), [], 0
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, held = [], 0
            ids.append(conv)
            size += 20
            held += 20
    if ids:
        rows.append((*key, ids[0], ",".join(map(str, ids))))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["conv_id", "depth", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()]
    rows: list[tuple] = []
    key = digest = None
    for batch in batches:
        for owner, depth, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == (owner, depth):
                digest.update(b"," + chunk.encode())
                continue
            if key is not None:
                rows.append((*key, digest.hexdigest()))
            key, digest = (owner, depth), hashlib.sha256(chunk.encode())
        if len(rows) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows = []
    if key is not None:
        rows.append((*key, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of each ``(conv_id, depth)``; ids are joined in ranges first, so a hot node gets few long rows."""
    n = parts(ends.sparkSession)
    each = ends.repartitionByRange(n, "owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id").select("owner", "depth", "conv_id")
    chunks = each.mapInArrow(_chunks, "conv_id long, depth long, least long, chunk string")
    dealt = chunks.repartition(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "least").select("conv_id", "depth", "chunk")
    return dealt.mapInArrow(_hashes, "conv_id long, depth long, ends_sha256 string")


# --- the tree


def prefix_tree(ids: DataFrame, steps: DataFrame) -> DataFrame:
    """One row for each node: of conversations ``ids`` and their ``prefixes``."""
    spark = ids.sparkSession
    facts = steps.agg(F.max("depth")).first()
    root = ids.agg(F.min("conv_id")).first()[0]
    if root is None:
        return spark.createDataFrame([], _NODE)
    owned = materialise(first_owned(ids, steps, root, facts[0] or 0))
    is_root = F.col("conv_id") == root
    has_chain = (F.col("first") <= F.col("n_turns")) | is_root
    ends = owned.select(F.when(has_chain, F.col("conv_id")).otherwise(F.col("below")).alias("owner"), F.col("n_turns").alias("depth"), "conv_id", "total")
    chains = owned.where(has_chain).select("conv_id", F.when(is_root, F.lit(None)).otherwise(F.col("below")).alias("parent"), F.when(is_root, -1).otherwise(F.col("first") - 1).cast("long").alias("attach"), "n_turns", (F.col("total") - F.col("below_cum")).alias("own"))
    chains = materialise(chains)
    told = ends.groupBy(F.col("owner").alias("conv_id")).agg(F.count("*").alias("n"), F.sum("total").alias("total"))
    forks = chains.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), F.col("attach").alias("n_turns")).agg(F.lit(0).alias("leaves"))
    seeds = chains.join(told, "conv_id", "left").join(forks, ["conv_id", "n_turns"], "left").fillna(0, ["n", "total"]).fillna(1, ["leaves"])
    totals = materialise(chain_totals(seeds.select("conv_id", "parent", "attach", "n", F.col("leaves").cast("long").alias("leaves"), "total", "own")))

    below = totals.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), F.col("attach").alias("depth"))
    below = below.agg(F.count("*").alias("forks"), *[F.sum(c).alias(f"in_{c}") for c in _SUMS])
    here = ends.groupBy(F.col("owner").alias("conv_id"), "depth").agg(F.count("*").alias("ended"), F.sum("total").alias("ended_total"))
    no_text = spark.createDataFrame([(root, 0, 0, 0)], "conv_id long, depth long, bytes long, cum long")
    nodes = steps.select("conv_id", "depth", "bytes", "cum").unionByName(no_text).join(chains, "conv_id").where(F.col("depth") > F.col("attach"))
    nodes = nodes.join(below, ["conv_id", "depth"], "left").join(here, ["conv_id", "depth"], "left").fillna(0, ["forks", *[f"in_{c}" for c in _SUMS], "ended", "ended_total"])
    last = F.col("depth") == F.col("n_turns")
    nodes = nodes.select(
        "conv_id", "depth", F.when(F.col("depth") - 1 > F.col("attach"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"), (F.col("forks") + F.when(last, 0).otherwise(1)).cast("long").alias("n_children"), (F.col("cum") - F.col("bytes")).alias("before"),
        (F.col("in_n") + F.col("ended")).alias("n"), (F.col("in_leaves") + F.when(last & (F.col("forks") == 0), 1).otherwise(0)).alias("leaves"), (F.col("in_total") + F.col("ended_total")).alias("total"), (F.col("in_own") + F.col("bytes")).alias("own"),
    )
    # sums along each chain from its end up are what the subtree of each node has
    summed = running(nodes, "conv_id", [F.col("depth").desc()], _SUMS, ["conv_id", "depth", "parent_conv_id", "n_children", "before"])
    saved = F.col("total") - F.col("n") * F.col("before") - F.col("own")
    out = summed.join(end_hashes(ends), ["conv_id", "depth"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    ids, again = rebuilt(materialise(numbered_turns(turns)))
    return prefix_tree(ids, materialise(prefixes(again)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


#: Each node's members from whole prefixes, sums over subtrees by listing every ancestor: for small tables.
OP12_SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), sized AS (SELECT conv_id, max(pos) AS n FROM own GROUP BY 1),
heads AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS h
  FROM sized
), ids AS (SELECT a.conv_id, a.h, a.base, least(a.h, coalesce(b.n, 0)) AS taken FROM heads a LEFT JOIN sized b ON b.conv_id = a.base),
turns AS (
  SELECT i.conv_id, o.pos AS depth, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.pos <= i.taken
  UNION ALL SELECT i.conv_id, o.pos - i.h + i.taken, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > i.h
), prefix AS (
  SELECT conv_id, depth, strlen(text) AS bytes, sha256(list(sha256(role || chr(0) || text)) OVER (PARTITION BY conv_id ORDER BY depth)::VARCHAR) AS node FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), lasts AS (SELECT conv_id, max(depth) AS last FROM prefix GROUP BY 1),
nodes AS (SELECT node, depth, min(conv_id) AS owner, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefix GROUP BY 1, 2),
edges AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN prefix p ON p.conv_id = n.owner AND p.depth = n.depth - 1),
forks AS (SELECT parent AS node, count(*) AS n_children FROM edges WHERE parent IS NOT NULL GROUP BY 1),
each AS (SELECT e.*, coalesce(f.n_children, 0) AS n_children, o.owner AS parent_conv_id FROM edges e LEFT JOIN forks f USING (node) LEFT JOIN nodes o ON o.node = e.parent),
subtree AS (
  SELECT p.node, sum(CASE WHEN e.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((e.n_convs - 1) * e.bytes) AS saved_tokens
  FROM each e JOIN prefix p ON p.conv_id = e.owner AND p.depth <= e.depth GROUP BY 1
), ended AS (SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ends FROM prefix p JOIN lasts l ON l.conv_id = p.conv_id AND l.last = p.depth GROUP BY 1)
SELECT e.owner AS conv_id, e.depth::BIGINT AS depth, e.parent_conv_id, e.n_convs::BIGINT AS n_convs, e.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(d.ends, '')) AS ends_sha256
FROM each e JOIN subtree s USING (node) LEFT JOIN ended d USING (node)
"""
