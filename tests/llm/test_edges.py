"""Every operator and every pipeline stage on awkward tables: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

CLASH = ["host", "page", "lines", "gone", "rest", "found", "leaks", "sha", "salt", "node", "bucket", "rank", "spans", "kept", "text_hash", "_drop", "_id", "length", "piece", "label", "component", "at", "ids", "words", "body", "no_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def row(doc, text, source="h"):
    return (doc, text, "en", source, None, *[c.upper() for c in CLASH])


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(40)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    million, tie = prose(170_000), prose(80)
    assert len(million) > 900_000
    out = [row(1, None), row(2, ""), row(3, " \n\t\r\n "), row(None, None), row(None, tie), row(4, tie), row(4, tie), row(4, prose(60)), row(5, tie.upper(), None), row(6, million), row(7, "x" * 100_000)]
    return [*out, row(8, "é ü — \U0001f600 " * 40), row(9, "\n".join(["same line"] * 300)), row(-10, prose(90), ""), row(2**62, prose(90))]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "some item of the benchmark that nobody has"), (2, None), (None, "no number here at all"), (3, "")], "item_id long, text string")


def operators(bench):
    from kilnspark.llm import decontaminate, licenses, line_rules, lm_score, near_dup, packing, pii, suffix_dedup, token_counts

    model = pii.trained()
    return {
        "op1": near_dup.near_duplicates, "op2": line_rules.quality, "op2_clean": line_rules.clean, "op3": lm_score.lattice_scores, "op4": suffix_dedup.remove_repeats,
        "op5": lambda d: decontaminate.find_leaks(d, bench, into="hits"), "op6": lambda d: pii.personal_data(d, model=model), "op7": token_counts.token_counts,
        "op8": line_rules.line_dedup, "op9": packing.pack, "op10": lambda d: licenses.scan(d, licenses.default_templates(d.sparkSession)),
    }


NAMES = ["op1", "op2", "op2_clean", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"]
#: One row comes out for each row that goes in.
ROW_BY_ROW = {"op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8"}


@pytest.mark.parametrize("name", NAMES)
def test_operator_on_awkward_rows(spark, awkward, bench, name):
    df = spark.createDataFrame(awkward, SCHEMA)
    out = operators(bench)[name](df)
    rows = out.collect()
    if name in ROW_BY_ROW:
        key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
        assert sorted(map(key, rows)) == sorted((r[0] is None, r[0] or 0) for r in awkward)
    if name in ("op5", "op8", "op2_clean"):
        assert out.columns[: len(df.columns)] == df.columns
        assert all(r[c] == c.upper() for r in rows for c in CLASH)
    # rows that are equal go out equal
    if name in ROW_BY_ROW and name != "op5":
        twice = [str(r) for r in rows if r["doc_id"] == 4]
        assert len(twice) == 3 and len(set(twice)) < 3


@pytest.mark.parametrize("name", NAMES)
def test_operator_on_an_empty_table(spark, bench, name):
    df = spark.createDataFrame([], SCHEMA)
    assert operators(bench)[name](df).collect() == []


def test_decontamination_by_an_empty_benchmark(spark, awkward):
    from kilnspark.llm.decontaminate import find_leaks

    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["hits"] == [] for r in find_leaks(spark.createDataFrame(awkward, SCHEMA), none, into="hits").select("hits").collect())


@pytest.mark.parametrize("name", ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"])
@pytest.mark.parametrize("empty", [False, True])
def test_stage(spark, awkward, bench, tmp_path, name, empty):
    import corpus_pipeline

    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.createDataFrame([] if empty else awkward, SCHEMA)
    out = dict(corpus_pipeline.STAGES)[name](spark, df, str(tmp_path))
    rows = out.collect()
    if empty:
        assert rows == []
    if name != "best_fit_packing":
        assert out.columns == df.columns and out.schema["text"].dataType == df.schema["text"].dataType
        assert all(r[c] == c.upper() for r in rows for c in CLASH)
    elif not empty:
        assert {r["doc_id"] for r in rows} == {r[0] for r in awkward}
    if name == "line_dedup" and not empty:
        assert len(rows) == len(awkward)


def test_pipeline_against_its_rules(spark, tmp_path):
    """Five stages by plain Python: what is left, and that its tokens are packed whole."""
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(91)
    prose = lambda n: " ".join(f"v{rng.randrange(20_000)}" for _ in range(n))
    item = prose(30)
    texts = {i: f"{prose(70)}\nShared footer of the site\n{prose(30)}" if i % 3 == 0 else prose(100) for i in range(60)}
    texts |= {100: "too short", 101: "a b c " * 40, 102: f"{prose(60)} {item} {prose(40)}", 103: texts[1], 104: texts[2] + " one more", 105: None, 106: "Shared footer of the site\n" * 40 + prose(20)}
    rows = [(i, t, "en", "one host", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {i: "\n".join(x for x in texts[i].split("\n") if x != "Shared footer of the site") for i in range(60)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in kept.items()}
    digest = lambda ids: zlib.crc32(b"".join(t.to_bytes(4, "little") for t in ids))
    got = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {(i, at, len(ids[at : at + 2048]), digest(ids[at : at + 2048])) for i, ids in want.items() for at in range(0, len(ids), 2048)}


def test_hot_host_line_and_page(spark):
    """One host holds most rows, one line is on every page, and one page is copied very often."""
    from kilnspark.llm.line_rules import clean, line_dedup

    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("every page\n" + "copied words " * 30).alias("text"), F.lit("hot").alias("source"))
    own = spark.range(3000, 3200).select(F.col("id").alias("doc_id"), F.concat(F.lit("every page\n"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), (F.col("id") * 61 + k).cast("string"))), " ")).alias("text"), F.lit("hot").alias("source"))
    df = copies.union(own)
    out = line_dedup(df).where("doc_id >= 3000")
    assert out.where(F.contains("text", F.lit("every page"))).count() == 0 and out.count() == 200
    assert clean(df).where(F.contains("text", F.lit("every page"))).count() == 0
