"""Golden micro-cases and invariants."""

import uuid

import pytest
from pyspark.sql import functions as F

from kilnspark.functions import extract as E
from kilnspark.functions.text import ngrams
from kilnspark.operators import balance as B
from kilnspark.operators import graph as G
from kilnspark.operators import metrics as M
from kilnspark.operators import samples as S
from kilnspark.plans import pattern
from kilnspark.sources import readers as R
from kilnspark.sources import sinks as K
from kilnspark.streaming import ingest as I


@pytest.mark.parametrize("source,target,cutoff", [(700, 300, 500), (40, 900, 512), (900, 40, 512), (255, 256, 512), (0, 80, 64), (80, 0, 64), (7, 9, 100)])
def test_infer_lengths(spark, source, target, cutoff):
    """A short answer stays whole, then a short prompt does, else both shrink in proportion."""
    s, t = M.infer_lengths(F.lit(source), F.lit(target), cutoff)
    got = tuple(spark.range(1).select(s.cast("int"), t.cast("int")).first())
    room = cutoff if 2 * target < cutoff else cutoff - source if 2 * source < cutoff else cutoff * target // (source + target)
    kept = min(room, target)
    assert got == (min(max(cutoff - kept, 0), source), kept) and sum(got) <= max(cutoff, 0)


def test_alpaca_joins_instruction_and_input(spark):
    rows = [("Name a river.", "In Asia", "Ob"), ("Name a lake.", "", "Erie"), (None, "only this", None)]
    out = S.align_alpaca(spark.createDataFrame(rows, "instruction string, input string, output string")).collect()
    assert [r["_prompt"][0]["content"] for r in out] == ["Name a river.\nIn Asia", "Name a lake.", "only this"]
    assert [len(r["_response"]) for r in out] == [1, 1, 0]


def test_uuid5(spark):
    space = uuid.uuid5(uuid.NAMESPACE_DNS, "example.org")
    for name in ("T1059", "é", ""):
        assert spark.range(1).select(E.uuid5(space.bytes, F.lit(name))).first()[0] == str(uuid.uuid5(space, name))


@pytest.mark.parametrize("vector,score", [("CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H", 9.8), ("CVSS:3.1/AV:N/AC:L/PR:N/UI:R/S:C/C:L/I:L/A:N", 6.1), ("CVSS:3.1/AV:L/AC:H/PR:H/UI:R/S:U/C:N/I:N/A:N", 0.0), ("CVSS:3.0/AV:P/AC:H/PR:L/UI:N/S:U/C:L/I:L/A:L", 3.8)])
def test_cvss(spark, vector, score):
    assert spark.range(1).select(M.cvss31(F.lit(vector))).first()[0] == pytest.approx(score)


def test_ngrams_of_short_texts_are_empty(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],)], "t array<string>")
    assert [r[0] for r in df.select(ngrams(F.col("t"), 3)).collect()] == [[], ["a b c"]]


def test_knapsack_holds_every_row_once_within_capacity(spark):
    df = spark.range(200).select("id", (F.col("id") * 37 % 90 + 1).alias("n"))
    out = S.knapsack(df, "id", "n", 100, F.col("id") % 3).join(df, "id").toPandas()
    assert sorted(out["id"]) == list(range(200))
    assert out.groupby(["shard", "bin"])["n"].sum().max() <= 100


def test_messages_that_do_not_alternate_become_empty(spark):
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")]), (2, [("user", "a"), ("user", "b")]), (3, [("system", "s"), ("user", "a"), ("assistant", "b")])], "id int, m array<struct<role:string,content:string>>")
    out = {r["id"]: r for r in S.align_messages(df, "m").collect()}
    assert [len(out[i]["_prompt"]) for i in (1, 2, 3)] == [1, 0, 1]
    assert out[3]["_system"] == "s"


def test_tool_messages_merge(spark):
    df = spark.createDataFrame([([("user", "q"), ("tool", "a"), ("tool", "b"), ("assistant", "c")],)], "m array<struct<role:string,content:string>>")
    out = df.select(S.merge_tools(F.col("m")).alias("m")).first()["m"]
    assert [m["role"] for m in out] == ["user", "tool", "assistant"]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    out = {r["node"]: r["component"] for r in G.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + i] == 100 for i in range(30))


def test_template_errors(spark):
    for text in ("no field", "{a:x.y>b:z} <* open", "{force a.b = c.d}", "{a:x}{a:y}"):
        with pytest.raises(pattern.TemplateError):
            pattern.parse(text)


def test_interleave_spreads_families(spark):
    df = spark.range(60).select("id", F.when(F.col("id") < 45, "a").otherwise("b").alias("f"))
    order = [r["f"] for r in B.interleave(df, "f", "id", "s").orderBy("pos", "f").collect()]
    assert all(2 <= order[i : i + 12].count("b") <= 4 for i in range(0, 60, 12))


def test_readers_skip_bad_lines_and_keep_them_on_request(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{bad\n{"a": 2}\n')
    path = str(tmp_path / "x.jsonl")
    assert sorted(r["a"] for r in R.read_jsonl(spark, path, "a int").collect()) == [1, 2]
    assert R.read_jsonl(spark, path, "a int", keep_bad=True).where("_corrupt_record is not null").cache().count() == 1


def test_comment_lines_archives_rules_and_registry(spark, tmp_path):
    import zipfile

    (tmp_path / "e.csv").write_text("#model\ncve,epss\nCVE-2024-1,0.5\n")
    assert R.read_delimited(spark, str(tmp_path / "e.csv"), "cve string, epss double", comment="#").collect()[0]["epss"] == 0.5
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/a.xml", "<x/>")
        z.writestr("b.txt", "no")
    assert [r["member"] for r in R.read_zip(spark, str(tmp_path / "z.zip"), ".xml").collect()] == ["d/a.xml"]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.yml").write_text("title: T\nlogsource:\n  product: windows\ntags:\n  - attack.t1059\n")
    got = {(r["key"], r["value"]) for r in R.read_yaml_rules(spark, str(tmp_path / "r")).collect()}
    assert got == {("title", "T"), ("logsource.product", "windows"), ("tags", "attack.t1059")}
    registry = R.Registry.from_config({"e": {"path": str(tmp_path / "e.csv"), "kind": "csv", "schema": "cve string, epss double"}})
    assert registry.enabled(None, ["e"]) == ["e"]
    with pytest.raises(KeyError):
        registry.enabled("e,unknown", [])


def test_array_sink_refuses_large_results(spark, tmp_path):
    with pytest.raises(ValueError):
        K.write_array(spark.range(11), str(tmp_path / "a"), most=10)


def test_stream_dedup_and_windows(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:10", "a"), ("2024-01-01 00:00:20", "b")], "ts string, text string").select(F.to_timestamp("ts").alias("ts"), "text")
    rows.write.parquet(str(tmp_path / "in"))
    stream = I.read_files(spark, str(tmp_path / "in"), "ts timestamp, text string")
    I.run_available(I.dedupe_stream(stream, "ts", "text", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_page_text_and_sentinels(spark):
    html = "<html><style>x{}</style><nav>menu</nav><p>Hello &amp; <b>bye</b></p><script>1</script></html>"
    assert spark.range(1).select(E.html_text(F.lit(html))).first()[0] == "Hello & bye"
    assert spark.range(1).select(E.collapse_prefixes(F.lit("CVE-CVE-2024-1 CWE-CWE-CWE-5"))).first()[0] == "CVE-2024-1 CWE-5"


def test_similarity_against_definitions():
    from kilnspark.operators.similarity import bleu4, rouge

    assert bleu4("same text", "same text") == pytest.approx(1.0) and bleu4("xyz", "abc") == 0.0
    # 4 of 5, 3 of 4, 2 of 3 and 1 of 2 n-grams, no brevity penalty
    assert bleu4("abcdx", "abcde") == pytest.approx((4 / 5 * 3 / 4 * 2 / 3 * 1 / 2) ** 0.25)
    assert bleu4("ab", "abcd") == pytest.approx(2.718281828459045 ** (1 - 4 / 2) * (1 * 1 * (1 / 2) * (1 / 4)) ** 0.25)
    one, two, longest = rouge("a b c d".split(), "a c d e".split())
    assert (one, two, longest) == (pytest.approx(6 / 8), pytest.approx(2 / 6), pytest.approx(6 / 8))


def test_pages_and_manifests():
    from kilnspark.functions.pages import read_page
    from kilnspark.sources import manifest as T

    page = read_page("<body><nav>menu</nav><h1>A <b>b</b></h1>Key: value<h2>S</h2><p>x<br>y</p><table><tr><th>k<td>v</table></body>")
    assert (page["title"], page["labels"], page["rows"]) == ("A b", {"Key": "value"}, [["k", "v"]])
    assert page["sections"][1] == {"heading": "S", "body": "x\ny\nk v"} and "menu" not in page["text"]
    assert read_page("<div id=m>in<div>side</div></div>out", ("#none", "#m"))["text"] == "in\nside"
    assert read_page("")["text"] == ""
    rows = T.parse_json('[{"id": 1, "instruction": "i", "question": "q", "answer": "a", "count_limit": "x"}, {"id": 2}]')
    assert len(rows) == 1 and rows[0][7] is None
    assert [T.resolve_limit(*x) for x in ((5,), (5, 7), (5, None, 3), (None, None, 3), (None,), (None, 0, 9))] == [5, 7, 3, 3, 10, 0]


def test_dispatch_tables(spark):
    from kilnspark.functions import answers as A
    from kilnspark.operators import dispatch as D

    table = D.Table("thing")

    @table.register("one")
    def one(x):
        return x + 1

    assert table("one", 2) == 3
    with pytest.raises(ValueError):
        table.register("one", one)
    with pytest.raises(KeyError):
        table("two")
    A.register_extractor("test-first", lambda t: F.substring(t, 1, 1))
    assert spark.range(1).select(A.extract_answer("test-first", F.lit("xy")), A.extract_answer("unknown", F.lit("xy"))).first() == ("x", "")
    with pytest.raises(ValueError):
        A.register_extractor("cve", A.first_cve)


def test_packed_samples_come_apart_again(spark):
    from kilnspark.operators import dialogue as D

    rows = [(i, [10 * i + k for k in range(n)], [-100] * (n // 2) + list(range(n - n // 2))) for i, n in enumerate((5, 9, 3, 7, 4))]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>, labels array<int>")
    bins = S.knapsack(df.withColumn("n", F.size("input_ids")), "id", "n", 12, F.lit(0))
    found = {}
    for r in D.pack_encoded(df, bins, "id", 12, neat=True).collect():
        assert len(r["input_ids"]) == len(r["labels"]) == len(r["attention_mask"]) == len(r["position_ids"]) == 13
        for number in {m for m in r["attention_mask"] if m}:
            at = [k for k, m in enumerate(r["attention_mask"]) if m == number]
            assert [r["position_ids"][k] for k in at] == list(range(len(at)))
            found[tuple(r["input_ids"][k] for k in at)] = [r["labels"][k] for k in at]
    assert found == {tuple(ids): labels for _, ids, labels in rows}


def test_numbering_is_the_row_number(spark):
    from kilnspark.operators.numbering import numbered

    df = spark.range(500).select("id", (F.col("id") * 7919 % 500).alias("k"), (F.col("id") % 3).alias("g"))
    out = numbered(df, ["k"]).collect()
    assert all(r["at"] == r["k"] for r in out) and len(out) == 500
    by = {}
    for r in numbered(df, ["k"], "place", "g").collect():
        by.setdefault(r["g"], []).append((r["k"], r["place"]))
    assert all([p for _, p in sorted(x)] == list(range(len(x))) for x in by.values())
    assert numbered(df.where("id < 0"), ["k"]).collect() == []


def test_hot_family_and_long_lists(spark):
    from kilnspark.operators import generate as N

    df = spark.range(400).select("id", F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")).alias("f"))
    out = B.interleave(df, "f", "id", "s").collect()
    hot = sorted(r["pos"] for r in out if r["f"] == "hot")
    assert len(out) == 400 and hot[0] == pytest.approx(0.5 * 400 / 300) and max(b - a for a, b in zip(hot, hot[1:])) < 1.4
    long_ = spark.createDataFrame([(1, [f"a{i}" for i in range(20)])], "k int, a array<string>")
    rows = N.alias_subsets(long_, "k", "a", 5, 6, "z").collect()
    assert {a for r in rows for a in r["subset"]} > {f"a{i}" for i in range(16)} and all(len(set(r["subset"])) == r["size"] for r in rows)
