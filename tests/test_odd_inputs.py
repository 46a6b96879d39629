"""Queries against their SQL on inputs that the driver's smallest tables don't have."""

import os

import duckdb

from kilnspark import catalog
from test_queries import plain


def held(spark, folder, name, **tables):
    """The query's rows over the tables given, each a list of rows and a schema, held against DuckDB's."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path := os.path.join(folder, f"{table}.parquet"))
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    df = catalog.QUERIES[name](spark, str(folder))
    found = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    same = lambda rows: sorted((tuple(plain(v) for v in r) for r in rows), key=str)
    out = same(tuple(r[c] for c in columns) for r in df.collect())
    assert sorted(columns) == sorted(df.columns) and out == same(found.fetchall())
    return out


def test_identifiers_are_told_before_they_are_upper_cased(spark, tmp_path):
    docs = [(1, "eine grossartige Sache"), (2, "eine großartige Sache"), (3, "GROSSARTIGE_x GROSSARTIGE1"), (4, "grossartıgeé ſchlüſſel"), (5, "so.Grossartige!"), (6, "strasſenbahn oﬃcefurniture"), (7, None), (8, "")]
    items = [(1, "GROSSARTIGE Strassenbahn"), (2, "officefurniture"), (3, "großzügige"), (4, None)]
    assert held(spark, tmp_path, "filter_exact_id_leak", documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string")) == [(1,), (5,)]


def test_titles_are_what_stands_in_the_first_bare_heading(spark, tmp_path):
    inner = ["a&&amp", "a &quot;b&quot; &amp;lt; &#39; &eacute;", " a\n\t b\x0b ", "", " ", "\u00a0\u3000a\u00a0", "a <b>b</b>\u2028", "a\u2028\u00a0\u2028", "&nbsp;a&amp;nbsp;", "\u0085"]
    pages = [(k, f"<html><nav>n</nav><article><h1>{t}</h1><p>x</p><h1>second</h1></article>") for k, t in enumerate(inner)]
    pages += [(100, "<h1 class='x'>a</h1>"), (101, "<h1>never closed"), (102, "<H1>a</H1>"), (103, None), (104, ""), (105, "<nav><h1>menu</h1></nav><h1>a</h1>"), (106, "<h1 id=a>a</h1><h1>b</h1>"), (107, "<h1>" + "x " * 50_000 + "</h1>")]
    out = dict(held(spark, tmp_path, "page_titles", pages=(pages, "page_id long, html string")))
    assert (out[0], out[3], out[101], out[105], out[106]) == ("a&&amp", "", "", "menu", "b") and not {100, 102, 103, 104} & out.keys()


def test_what_readers_of_calls_are_given_is_worked_out_once(spark):
    """Within functions of elements an expression would be worked out for each of them."""
    from pyspark.sql import functions as F

    from kilnspark.operators import tools as T

    given = spark.createDataFrame([("x",)], "t string").select(F.upper("t").alias("t"), F.array(F.struct(F.col("t").alias("name"), F.col("t").alias("arguments"))).alias("calls"))
    for d in T.DIALECTS:
        plan = given.select(T.extract_calls(F.concat("t", F.lit("-once-")), d).alias("x"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("-once-") == 1, d
        calls = F.transform("calls", lambda c: F.struct(F.concat(c["name"], F.lit("-once-")).alias("name"), c["arguments"].alias("arguments")))
        assert given.select(T.call_text(calls, d).alias("x"))._jdf.queryExecution().analyzed().toString().count("-once-") == 1, d


def test_calls_of_odd_texts_come_back(spark, tmp_path):
    texts = ["plain words", "", " ", "true", "the null", "false friends", "a  b", "0 1 2", "'quoted' \"twice\" {x} [y], z: \\ é", "tab\there\nand\nlines", "n", " ", None, "word " * 300]
    rows = [(k, k % 3, ["user", "assistant", "system"][k % 3], t) for k, t in enumerate(texts)]
    assert len(held(spark, tmp_path, "tool_calls_back", conversations=(rows, "conv_id long, turn long, role string, text string"))) == 12 * (len(rows) - 1)


def test_draws_are_never_broadcast(spark):
    """The planner takes 25 draws of up to nine rows for the one context that they are worked out from."""
    from pyspark.sql import functions as F

    from kilnspark.operators import samples as S

    docs = spark.range(300).select("id", F.repeat(F.lit("word "), F.lit(100)).alias("text"), F.lit("n").alias("name"), F.lit("q").alias("q"))
    plan = S.drawn_contexts(docs, "id", "text", "name", "q", 2000, "s", (3, 9), (1000, 2000))._jdf.queryExecution().executedPlan().toString()
    shared = [part for part in plan.split("BroadcastExchange")[1:] if "attempt" in part.split("Exchange hashpartitioning")[0]]
    assert "Generate" not in plan and not shared, plan


def test_sides_that_meet_give_each_text_once(spark, tmp_path, monkeypatch):
    """Names in several nations, names that hold the sign between them, nations beyond a tile."""
    from kilnspark.plans import pattern

    monkeypatch.setattr(pattern, "TILE", 3)
    one = [("region", ([(0, "r")], "r_regionkey long, r_name string")), ("orders", ([(1, 1, "a", "O")], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string"))]
    nations = [(n, f"n{n}", 0) for n in range(4)]
    names = ["a", "a|b", "b", "a|b|c", "|", "x", "y", "z", "é", "w"]
    customers = [(k, names[k % 10] if k < 40 else f"c{k}", "BUILDING" if k % 9 else "OTHER", 4990.0 + k, k % 3 if k % 10 != 7 else 0) for k in range(90)]
    suppliers = [(k, ["c", "b|c", "b", "c|", "q", "|b"][k % 6] if k < 20 else f"s{k}", k % 4) for k in range(40)]
    out = held(
        spark, tmp_path, "graph_shared_variables", nation=(nations, "n_nationkey long, n_name string, n_regionkey long"), customer=(customers, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double, c_nationkey long"),
        supplier=(suppliers, "s_suppkey long, s_name string, s_nationkey long"), **dict(one),
    )
    assert ("a|b|c",) in out and len(out) == len(set(out)) > 500


def test_a_product_of_sides_is_not_shuffled(spark):
    """Nor are there sides where a variable that is printed, or a condition, ties them."""
    from kilnspark.operators import graph as G
    from kilnspark.plans import pattern

    g = G.star_schema(spark, "/root/testdata/sf0.001")
    plan = lambda t: pattern.run(g, t)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(text" not in plan("<*{c:customer.lives_in>n:nation}{s:supplier.based_in>n:nation}*>{c.name}|{s.name}")
    for tied in ("*>{c.name}|{s.name} {n.name}", "{force c.name < s.name}*>{c.name}|{s.name}", "*>{c.name}{s.name}"):
        assert pattern._meeting(pattern.parse("<*{c:customer.lives_in>n:nation}{s:supplier.based_in>n:nation}" + tied)) is None
    assert pattern._meeting(pattern.parse("<*{a:nation.part_of>r:region}{b:nation.part_of>r:region}*>{a.name}-{b.name}")) is None
