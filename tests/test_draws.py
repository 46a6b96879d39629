"""First rows of hot families, names in texts, drawn contexts: against plain Python."""

import hashlib
import io
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from kilnspark.operators import aliases as L
from kilnspark.operators import balance as B
from kilnspark.operators import samples as S


def md5(*x):
    return hashlib.md5("|".join(map(str, x)).encode()).hexdigest()


def first(rows, k, seed):
    by = {}
    for f, key in rows:
        by.setdefault(f, []).append((md5(seed, key), key))
    return {key for f, v in by.items() for _, key in sorted(v)[: k(len(v))]}


@pytest.mark.parametrize("digits", [1, 4])
def test_first_of_hot_families(spark, monkeypatch, digits):
    monkeypatch.setattr(B, "BIN_DIGITS", digits)
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "", '"]']), k) for k in range(3000)] + [("lone", 5000)]
    df = spark.createDataFrame(rows, "f string, k long").withColumn("extra", F.lit(1))
    for k in (0, 1, 7, 400, 10_000):
        assert {r.k for r in B.cap(df, "f", "k", k, "s").collect()} == first(rows, lambda n, k=k: min(k, n), "s")
    assert {r.k for r in B.fraction(df, "f", "k", 0.03, "s").collect()} == first(rows, lambda n: max(1, -int(-0.03 * n // 1)), "s")
    split = B.validation_slice(df, "f", "k", 50, "s").collect()
    assert len(split) == len(rows) and {r.k for r in split if r.split == "val"} == first(rows, lambda n: 50, "s")
    assert B.cap(df.limit(0), "f", "k", 5, "s").collect() == []


def test_no_window_over_a_family(spark):
    df = spark.range(20_000).select((F.col("id") % 2).cast("string").alias("f"), "id")
    bins = df.select("f", F.substring(B.draw("s", "id"), 1, B.BIN_DIGITS).alias("b")).groupBy("f", "b").count()
    assert bins.agg(F.max("count")).first()[0] < 20  # what the one ranked bin of a family may hold
    text = io.StringIO()
    with redirect_stdout(text):
        B.firsts(df, ["f"], "id", "s", lambda n: 100).explain()
    ranked = text.getvalue().split("Window [row_number")[1]
    assert "_bin" in ranked and "_border" in ranked  # it stands above the filter on the border bin


def whole(name, text):
    return re.search(r"(?:^|[^a-z0-9])" + re.escape(name) + r"(?:$|[^a-z0-9])", text)


def test_names_in_texts(spark):
    rng = random.Random(5)
    names = ["apt29", "apt 29", "cozy bear", "bear", "c++ crew", "the dukes", "ab", "安全", "安全 crew", "x.y/z", "(odd)", "ém", "a-b-c-d", "29"]
    words = [*names, "group", "!", ".", "the", "é", "x", "安", "crew", "b", " - ", "APT29", "\n"]
    texts = [(k, rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randrange(6)))) for k in range(900)]
    texts += [(1000, None), (1001, ""), (1002, " Bear "), (1003, "x" * 50_000 + " cozy bear " + "y z " * 20_000)]
    found = {r.k: r.actor for r in L.resolve(spark.createDataFrame(texts, "k int, t string"), "k", "t", spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    for k, t in texts:
        t = (t or "").strip(" ").lower()
        held = [n for n in names if len(n) >= 3 and whole(n, t)]
        want = t if t in names or not held else min(held, key=lambda n: (-len(n), t.find(n), n))
        assert found[k] == want, t
    none = L.resolve(spark.createDataFrame([(1, "Hi")], "k int, t string"), "k", "t", spark.createDataFrame([], "name string")).collect()
    assert [tuple(r) for r in none] == [(1, "hi")]


def test_drawn_contexts(spark):
    rng = random.Random(7)
    rows = [(10 * k, "x" * rng.randrange(1, 900) + " end ", f"n{k % 3}" if k % 5 else None, f" ask {k} ") for k in range(80)] + [(5, "", "n", "q"), (7, None, "n", "q")]
    df = spark.createDataFrame(rows, "id long, text string, name string, q string")
    found = {r.context: r for r in S.drawn_contexts(df, "id", "text", "name", "q", 40, "z", (3, 8), (1500, 2200), 6).collect()}
    pool = sorted(r for r in rows if r[1])
    place = lambda *x: int(md5("z", *x)[:15], 16)
    for c in range(40):
        for a in range(7):
            n = 8 if a == 6 else 3 + place(c, a, "n") % 6
            drawn = list(dict.fromkeys(place(c, a, j) % len(pool) for j in range(8 * n)))[:n]
            total = sum(len(pool[i][1]) for i in drawn)
            if 1500 <= total <= 2200 or a == 6:
                break
        held = [pool[i] for i in drawn]
        asked = max(held, key=lambda r: len(r[1]))
        body = "".join(f"\nSECTION {i + 1} ({r[2] or 'section'})\n{'-' * 60}\n{r[1].strip(' ')}" for i, r in enumerate(held))
        report = "THREAT INTELLIGENCE REPORT\n" + "=" * 60 + body + "\n\nQUESTION\n" + "-" * 60 + "\n" + asked[3].strip()
        r = found[c]
        assert (r.attempt, r.n_rows, r.chars, r.question_of, r.report, r.answer) == (a, n, total, asked[0], report, asked[1].strip())
    assert {r.attempt for r in found.values()} > {0, 6} or len({r.attempt for r in found.values()}) > 2
    few = S.drawn_contexts(df.where("id < 30"), "id", "text", "name", "q", 3, "z", (3, 8), (1500, 2200), 2).collect()
    assert len(few) == 3 and all(r.n_rows <= 5 for r in few)
    assert S.drawn_contexts(df.limit(0), "id", "text", "name", "q", 3, "z").collect() == []
