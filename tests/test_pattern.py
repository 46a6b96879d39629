"""Staged draws and bounded queries of path patterns."""

import io
import time
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from kilnspark.operators.graph import Graph
from kilnspark.plans import pattern


@pytest.fixture(scope="module")
def hub(spark):
    """One group uses every technique, the others a few; each technique has mitigations."""
    g = Graph()
    g.add_nodes("grp", spark.range(20).select("id", F.concat(F.lit("g"), F.col("id")).alias("name")))
    g.add_nodes("tech", spark.range(300).select("id", F.concat(F.lit("t"), F.col("id")).alias("name")))
    g.add_nodes("mit", spark.range(40).select("id", F.concat(F.lit("m"), F.col("id")).alias("name")))
    g.add_edges("uses", "grp", "tech", spark.range(300).selectExpr("0 AS src", "id AS dst").union(spark.range(60).selectExpr("1 + id % 18 AS src", "id AS dst")))
    g.add_edges("stopped", "tech", "mit", spark.range(900).selectExpr("id % 300 AS src", "(id * 7) % 40 AS dst"))
    return g


TEMPLATE = "<*{a:grp.uses>t:tech.stopped>m:mit}{b:grp.uses>t:tech}*>{a.name} {b.name} {t.name} {m.name}"


def test_each_draw_is_one_of_the_bindings(hub):
    texts = {r.text for r in pattern.run(hub, TEMPLATE).collect()}
    rows = pattern.sample_staged(hub, TEMPLATE, "a", 200, "s").collect()
    assert len({r.draw for r in rows}) == len(rows) > 120 and {r.text for r in rows} <= texts
    assert rows == pattern.sample_staged(hub, TEMPLATE, "a", 200, "s").sort("draw").collect() or {tuple(r) for r in rows} == {tuple(r) for r in pattern.sample_staged(hub, TEMPLATE, "a", 200, "s").collect()}


def test_primaries_come_evenly(hub):
    drawn = [r.text.split()[0] for r in pattern.sample_staged(hub, "<*{a:grp.uses>t:tech}*>{a.name} {t.name}", "a", 1900, "x").collect()]
    counts = [drawn.count(f"g{k}") for k in range(19)]
    assert min(counts) > 50 and max(counts) < 160  # 95 each; the hub has no more than its share
    hubs = {r.text for r in pattern.sample_staged(hub, "<*{a:grp.uses>t:tech}*>{a.name} {t.name}", "a", 1900, "x").collect() if r.text.startswith("g0 ")}
    assert len(hubs) > 50  # a primary drawn again leads elsewhere


def test_no_stage_holds_the_product(hub, monkeypatch):
    seen = []
    write = pattern.materialise
    monkeypatch.setattr(pattern, "materialise", lambda df: seen.append((out := write(df)).count()) or out)
    pattern.sample_staged(hub, TEMPLATE, "a", 30, "s").collect()
    assert max(seen) <= 30


def test_without_replacement_and_paths_from_the_primary(hub):
    rows = pattern.sample_staged(hub, "<*{a:grp.uses>t:tech}*>{a.name}", "a", 50, "s", replace=False).collect()
    assert len({r.text for r in rows}) == len(rows) == 19
    with pytest.raises(pattern.TemplateError, match="no path"):
        pattern.sample_staged(hub, "<*{a:grp}{m:mit}*>{a.name} {m.name}", "a", 5, "s")
    with pytest.raises(pattern.TemplateError, match="not bound"):
        pattern.sample_staged(hub, "<*{a:grp}*>{a.name}", "z", 5, "s")


def test_drawn_primaries_come_before_the_expansion(hub):
    out = io.StringIO()
    with redirect_stdout(out):
        pattern.sample_distinct(hub, TEMPLATE, "a", 3, "s", limit=1000).explain()
    plan = out.getvalue()
    assert "TakeOrderedAndProject" in plan and "LeftSemi" in plan
    rows = [r.text for r in pattern.sample_distinct(hub, TEMPLATE, "a", 3, "s", limit=1000).collect()]
    drawn = {f"g{r.id}" for r in pattern.drawn_primaries(hub, pattern.parse(TEMPLATE), "a", 3, "s").collect()}
    every = {r.text for r in pattern.run(hub, TEMPLATE).collect() if r.text.split()[0] in drawn}
    assert set(rows) == every and len(rows) == len(every) > 0


def test_primary_query_is_interrupted_and_the_fallback_answers(spark):
    g = Graph()
    g.nodes["a"] = spark.range(3_000_000).select("id", (F.col("id") % 7).cast("string").alias("name"))
    g.nodes["b"] = spark.range(3_000_000).select("id", (F.col("id") % 5).cast("string").alias("name"))
    template = "<*{x:a}{y:b}*>{x.name}{y.name}"
    began = time.time()
    rows, complete = pattern.run_bounded(g, template, 20, "s", seconds=4.0)
    assert not complete and time.time() - began < 60
    texts = [r.text for r in rows.collect()]
    assert 0 < len(texts) <= 20 and len(set(texts)) == len(texts)
    # the session goes on, and what has time is complete
    g.nodes = {k: v.where("id < 100") for k, v in g.nodes.items()}
    rows, complete = pattern.run_bounded(g, template, 20, "s", seconds=60.0)
    assert complete and rows.count() == 20


def test_other_errors_are_raised(spark):
    g = Graph()
    g.nodes["a"] = spark.range(5).select("id", F.raise_error(F.lit("broken")).cast("string").alias("name"))
    with pytest.raises(Exception, match="broken"):
        pattern.run_bounded(g, "<*{x:a}*>{x.name}", 5, seconds=30.0)
