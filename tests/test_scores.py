"""Rank correlations, scores by question and best answers on small cases."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kilnspark.operators import metrics as M


def test_spearman_with_ties_and_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(8), rng.choice([0.5, 1.5, -3.0, 7.25])) for _ in range(400)]
    rows = [(a, b + a / 4) for a, b in rows] + [(None, 1.0), (2, None)]
    found = M.spearman(spark.createDataFrame(rows, "p int, g double"), "p", "g").first()
    frame = pd.DataFrame(rows[:-2], columns=["p", "g"])
    assert found.spearman == pytest.approx(np.corrcoef(frame.p.rank(), frame.g.rank())[0, 1]) and found.pearson == pytest.approx(np.corrcoef(frame.p, frame.g)[0, 1])
    flat = M.spearman(spark.createDataFrame([(1, 2.0), (1, 3.0)], "p int, g double"), "p", "g").first()
    assert flat.spearman is None and M.spearman(spark.createDataFrame([], "p int, g double"), "p", "g").first().pearson is None


def test_questions(spark):
    rows = [(1, 1, 1), (1, 0, 0), (2, 1, 0), (2, 1, 1), (3, 0, 0)]
    found = M.question_scores(spark.createDataFrame(rows, "q int, p int, g int"), "q", "p", "g").first()
    assert tuple(found) == pytest.approx((2 / 3, (1 + 2 / 3 + 0) / 3, 2 * 2 / (3 + 2)))


def test_best_answers(spark):
    rows = [("The U.S.A!", ["usa", "x"]), ("red red dog", ["a red dog", "cat"]), ("nothing", ["else"]), ("x", []), ("", ["the"])]
    em, f1 = M.best_answer(F.col("p"), F.col("g"))
    found = [tuple(r) for r in spark.createDataFrame(rows, "p string, g array<string>").select(em, f1).collect()]
    assert [x[0] for x in found] == [1, 0, 0, 0, 1] and [x[1] for x in found] == pytest.approx([1, 2 * 2 / 5, 0, 0, 0])
