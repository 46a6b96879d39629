"""The conversation trie against a dictionary of whole prefixes."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest

from kilnspark.llm import prefix_trie

DATA = "/root/testdata/sf0.001"


def order(t):
    return (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())


def rebuilt(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn, role or "", text or ""))
    by = {c: [t[1:] for t in sorted(ts, key=order)] for c, ts in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(by.get(c - c % 5, [])[:h] + own[h:])
    return out


def expected(rows):
    return tree(rebuilt(rows))


def tree(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        if not below[node]:
            leaves[node] = 1
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode())
            below[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = {}
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        key = (min(ids), len(node))
        assert key not in out
        out[key] = (min(members[node[:-1]]) if node else None, len(ids), below[node], leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def answers(df):
    rows = df.collect()
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(found) == len(rows)
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def fixture():
    rng = random.Random(8)
    rows = []
    for conv in range(150):
        if conv % 5 == 0 and rng.random() < 0.3:
            continue  # families without a head
        for turn in range(rng.randrange(1, 10)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["é", "b", "long text", ""])))
    # copies, and one conversation far longer than the rest
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1100) for t in range(12)]
    rows += [(2000, t, "user", f"turn {t % 7}") for t in range(900)] + [(2001, t, "user", f"turn {t % 7}") for t in range(700)]
    rows += [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "x"), (7, 3, "user", "x"), (7, 3, "user", "x"), (-4, 0, "user", "neg"), (-3, 0, "user", "neg")]
    return rows


def test_against_whole_prefixes(spark):
    rows = fixture()
    # like Spark's and DuckDB's, the remainder of a negative id is negative
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    assert answers(prefix_trie.conversation_trie(frame(spark, rows))) == expected(rows)


def test_order_of_rows_does_not_matter(spark):
    rows = [r for r in fixture() if r[0] is None or 0 <= r[0] < 1200]
    want = expected(rows)
    random.Random(2).shuffle(rows)
    assert answers(prefix_trie.conversation_trie(frame(spark, rows).repartition(5))) == want


def given_tree(spark, convs):
    turns = [(c, d + 1, hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest(), len(t.encode())) for c, ts in convs.items() for d, (r, t) in enumerate(ts)]
    steps = prefix_trie.prefixes(spark.createDataFrame(turns, "conv_id long, depth long, key string, bytes long"))
    return prefix_trie.prefix_tree(spark.createDataFrame([(c,) for c in convs], "conv_id long"), steps)


def test_chains_below_chains(spark):
    # each conversation leaves its forerunner one turn later: the tree of chains is a path
    convs = {k: tuple(("user", f"t{j}") for j in range(k)) + (("user", f"own {k}"),) * 2 for k in range(9)}
    assert answers(given_tree(spark, convs)) == tree(convs)


def test_no_turns_at_all(spark):
    convs = {5: (), 3: (), 9: (("user", "a"),)}
    assert answers(given_tree(spark, convs)) == tree(convs)


def test_hot_digests_are_few(spark, monkeypatch):
    rows = [r for r in fixture() if r[0] is not None and 0 <= r[0] < 1200]
    for hot in (1, 10**9):  # all by shuffle, all by broadcast
        monkeypatch.setattr(prefix_trie, "HOT", hot)
        assert answers(prefix_trie.conversation_trie(frame(spark, rows))) == expected(rows)


def test_ends_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 100)
    rows = [(c, 0, "user", "same") for c in range(0, 3000)]
    assert answers(prefix_trie.conversation_trie(frame(spark, rows))) == expected(rows)


def test_running_sums_of_a_group_in_many_ranges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, k, k % 3) for k in range(2000)] + [(g, 0, 5) for g in range(2, 40)], "g long, k long, v long").repartition(9)
    found = {(r.g, r.k): r.v for r in prefix_trie.running(df, "g", [F.col("k")], ["v"], ["g", "k"]).collect()}
    total = 0
    for k in range(2000):
        total += k % 3
        assert found[1, k] == total
    assert all(found[g, 0] == 5 for g in range(2, 40)) and len(found) == 2038


def test_empty_table_and_clashing_columns(spark):
    assert prefix_trie.conversation_trie(frame(spark, [])).collect() == []
    assert prefix_trie.conversation_trie(frame(spark, [(None, 1, "user", "a")])).collect() == []
    rows = [r for r in fixture() if r[0] is not None and 0 <= r[0] < 100]
    more = frame(spark, rows).selectExpr("*", "text AS key", "turn AS pos", "turn AS depth", "role AS bytes", "1 AS n", "2 AS _part")
    assert answers(prefix_trie.conversation_trie(more)) == expected(rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answers(prefix_trie.op12_prefix_trie(spark, DATA)) == expected(rows)
