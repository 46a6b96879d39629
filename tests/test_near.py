"""Near-duplicate joins against whole sets and a plain loop in the order of ids."""

import random
import re

import numpy as np
import pytest

from kilnspark.operators import near, skew


def sets_of(text, n=13):
    t = re.findall(r"[a-z0-9_.-]+", text.lower())
    return {" ".join(t[i : i + n]) for i in range(len(t) - n + 1)}


def jaccard(a, b):
    return 1000 * len(a & b), len(a | b)


def greedy(texts, threshold=800):
    kept, gone = [], set()
    for i, s in sorted((i, sets_of(t)) for i, t in texts):
        if not s:
            continue
        for k in kept:
            shared, union = jaccard(s, k)
            if shared >= threshold * union:
                gone.add(i)
                break
        else:
            kept.append(s)
    return gone


def words(rng, n, vocabulary=4000):
    return [f"wo{rng.randrange(vocabulary)}" for _ in range(n)]



def corpus(seed=4):
    """Chains whose similarity decays, stars, copies, texts that share a long passage, short texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        w = words(rng, rng.randrange(60, 400))
        for _ in range(12):
            texts.append(" ".join(w))
            # one word after another at one end: neighbours are near, far ones aren't
            w = w[rng.randrange(1, 12) :] + words(rng, rng.randrange(1, 12))
    base = words(rng, 300)
    texts += [" ".join(base[: 300 - k % 5] + words(rng, 2)) for k in range(80)]
    passage = words(rng, 120)
    texts += [" ".join(passage + words(rng, 60)) for _ in range(60)]
    texts += [" ".join(words(rng, k)) for k in range(15)] + [""]
    rng.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, texts, name="doc_id"):
    return spark.createDataFrame([(i, t) for i, t in texts], f"{name} long, text string")


def dropped(spark, texts):
    return {r.id for r in near.first_wins(near.materialise(near.shingle_sets(frame(spark, texts), "doc_id"))).collect()}


def test_first_wins_is_the_greedy_set(spark):
    texts = corpus()
    assert dropped(spark, texts) == greedy(texts)


@pytest.mark.parametrize("stars", [0, 1])
def test_rare_shingles_find_all_that_bands_leave(spark, monkeypatch, stars):
    monkeypatch.setattr(near, "STARS", stars)
    texts = corpus(9)
    assert dropped(spark, texts) == greedy(texts)


def test_a_group_of_copies_costs_a_star(spark):
    rng = random.Random(1)
    base = words(rng, 200)
    texts = [(k, " ".join([*base, f"n{k}"])) for k in range(600)]
    assert dropped(spark, texts) == set(range(1, 600))


def test_recall_at_both_thresholds(spark):
    rng = random.Random(6)
    items, docs = [], []
    for k in range(150):
        w = words(rng, 120, 10**6)
        items.append((k, " ".join(w)))
        docs.append((k, " ".join(words(rng, 30, 10**6) + w[: rng.randrange(60, 120)] + words(rng, 30, 10**6))))
    want = {i for (i, d), (_, t) in zip(docs, items) if (j := jaccard(sets_of(d), sets_of(t)))[0] >= 300 * j[1]}
    found = {r.id for r in near.near_items(near.shingle_sets(frame(spark, docs), "doc_id"), near.shingle_sets(frame(spark, items, "item_id"), "item_id")).collect()}
    assert 30 < len(want) < 150 and found == want
    pairs = [(w := words(rng, 200, 10**6), w[rng.randrange(22) :]) for _ in range(200)]
    texts = [(2 * k + j, " ".join(w)) for k, pair in enumerate(pairs) for j, w in enumerate(pair)]
    assert dropped(spark, texts) == greedy(texts) and len(greedy(texts)) > 100


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(-(2**63), 2**63, 1000)
    b = np.r_[a[:800], rng.integers(-(2**63), 2**63, 200)]
    assert abs((near.minhash(a) == near.minhash(b)).mean() - 800 / 1200) < 0.15
    assert (near.minhash(np.r_[a, a]) == near.minhash(a)).all()


def test_reasons_by_a_plain_loop(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    items = [(k, " ".join(words(rng, 80))) for k in range(6)]
    docs = []
    for k in range(160):
        kind = k % 8
        w = words(rng, 90)
        text = " ".join(w)
        if kind == 1:
            text = items[k % 6][1] + " " + " ".join(words(rng, 30))
        elif kind == 2:
            text = "short"
        elif kind in (3, 4):
            text = " ".join(random.Random(k // 32).choices([f"abc{j}" for j in range(5000)], k=120)) + (" tail" if kind == 4 else "")
        elif kind == 5:
            text += " SECRETNAME"
        docs.append((k, f"s{k % 2}", text))
    docs += [(200, "s0", None), (201, "s1", docs[5][2]), (202, "s0", docs[5][2])]
    items.append((6, "SECRETNAME only"))
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    ids = lambda c: F.regexp_extract_all(c, F.lit("[A-Z]{6,}"), F.lit(0))
    found = {r.doc_id: r.reason for r in near.corpus_reasons(df, bench, ids, F.col("source") == "s1").collect()}
    want, kept, hashes = {}, [], set()
    bench_sets = [sets_of(t) for _, t in items]
    for i, source, text in docs:
        if text is None or len(text) < 100 or len(re.findall("[A-Za-z]{2,}", text)) < 15:
            want[i] = "quality"
        elif source == "s1" and "SECRETNAME" in text:
            want[i] = "leak_exact"
        elif any((j := jaccard(sets_of(text), b))[0] >= 300 * j[1] and b for b in bench_sets):
            want[i] = "leak_near"
        elif text in hashes or any((j := jaccard(sets_of(text), k))[0] >= 800 * j[1] for k in kept):
            want[i] = "near_dup"
        else:
            want[i] = "kept"
            kept.append(sets_of(text))
            hashes.add(text)
    assert found == want and set(want.values()) == {"quality", "leak_exact", "leak_near", "near_dup", "kept"}


def test_empty_corpus(spark):
    assert dropped(spark, []) == set() and dropped(spark, [(1, None), (2, "a b")]) == set()


def test_joins_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SHARE", 4)
    rows = spark.createDataFrame([(k, k % 7 if k % 2 else 100) for k in range(400)], "id long, key long")
    keyed = spark.createDataFrame([(k, 200 if k == 100 else 30, f"v{k}") for k in [*range(7), 100]], "key long, n long, v string")
    assert {(r.id, r.v) for r in skew.join_counted(rows, keyed, "key", "n", 400).collect()} == {(k, f"v{k % 7 if k % 2 else 100}") for k in range(400)}
    values = keyed.select("key", "v")
    found = skew.join_replicated(rows, values, "key", step=16)
    assert sorted((r.id, r.v) for r in found.collect()) == [(k, f"v{k % 7 if k % 2 else 100}") for k in range(400)]
