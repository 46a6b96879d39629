"""Queries of readers, sinks, renderers and tokenizers: files are written from the driver's tables and read again."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from kilnspark.operators import build as U
from kilnspark.operators import dialogue as D
from kilnspark.operators import generate as N
from kilnspark.operators import render as R
from kilnspark.operators import samples as S
from kilnspark.registry import query, table
from kilnspark.sources import readers as I
from kilnspark.sources import sinks as K
from kilnspark.sources.workspace import folder
from kilnspark.streaming import ingest as T


@query("scan_json_array", "SELECT n_nationkey, n_name FROM nation")
def scan_json_array(spark, sf):
    """One array in one file, written by the sink for arrays and read as one JSON value."""
    path = folder(spark)
    K.write_array(table(spark, sf, "nation").select("n_nationkey", "n_name"), path)
    return I.read_json(spark, path, "n_nationkey long, n_name string")


@query("scan_any_format", "SELECT 'jsonl' AS kind, item_id, text FROM benchmark UNION ALL SELECT 'csv', item_id, text FROM benchmark UNION ALL SELECT 'tsv', item_id, text FROM benchmark UNION ALL SELECT 'limited', item_id, text FROM benchmark WHERE item_id < 0")
def scan_any_format(spark, sf):
    """The reader goes by the suffix; a limit of no rows gives none."""
    b = table(spark, sf, "benchmark")
    root, schema = folder(spark), "item_id long, text string"
    b.write.json(f"{root}/a.jsonl")
    b.write.option("header", True).option("escape", '"').csv(f"{root}/a.csv")
    b.write.option("header", True).option("escape", '"').option("sep", "\t").csv(f"{root}/a.tsv")
    out = [I.read_any(spark, f"{root}/a.{k}", schema).select(F.lit(k).alias("kind"), "item_id", "text") for k in ("jsonl", "csv", "tsv")]
    return out[0].union(out[1]).union(out[2]).union(I.read_any(spark, f"{root}/a.jsonl", schema, 0).select(F.lit("limited"), "item_id", "text"))


@query("scan_bundle", "SELECT 'tool--' || c_custkey AS id, c_name AS name FROM customer")
def scan_bundle(spark, sf):
    """A bundle of objects in one file, one row each."""
    path = folder(spark)
    objects = table(spark, sf, "customer").select(F.to_json(F.struct(F.lit("tool").alias("type"), F.concat(F.lit("tool--"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"))).alias("j"))
    objects.agg(F.concat(F.lit('{"type": "bundle", "objects": ['), F.array_join(F.collect_list("j"), ","), F.lit("]}")).alias("value")).coalesce(1).write.text(path)
    return I.read_bundle(spark, path, "type:string,id:string,name:string").where("type = 'tool'").select("id", "name")


@query("scan_zip", "SELECT r_name AS member, r_regionkey AS n FROM region")
def scan_zip(spark, sf):
    """Members of an archive, by suffix."""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for r in table(spark, sf, "region").collect():  # five rows
            z.writestr(f"in/{r['r_name']}.json", f'{{"n": {r["r_regionkey"]}}}')
            z.writestr(f"in/{r['r_name']}.txt", "no")
    path = folder(spark)
    K.write_bytes(spark, f"{path}/a.zip", data.getvalue())
    z = I.read_zip(spark, path, ".json")
    return z.select(F.regexp_extract("member", r"in/(.*)\.json", 1).alias("member"), F.from_json("content", "n long")["n"].alias("n"))


@query("scan_rules", "SELECT n_name AS title, 'r' || n_regionkey AS product, 'attack.t10' || lpad(n_nationkey::VARCHAR, 2, '0') AS tag FROM nation")
def scan_rules(spark, sf):
    """Rule files of the YAML subset, one in each file."""
    n = table(spark, sf, "nation")
    text = F.concat(F.lit("# rule\ntitle: '"), "n_name", F.lit("'\nlogsource:\n  product: r"), F.col("n_regionkey").cast("string"), F.lit("\ntags:\n  - attack.t10"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("\n"))
    path = folder(spark)
    for r in n.select("n_nationkey", text.alias("t")).collect():  # 25 files
        K.write_bytes(spark, f"{path}/{r['n_nationkey']}.yml", r["t"].encode())
    rules = I.read_yaml_rules(spark, path)
    one = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    return rules.groupBy("path").agg(one("title").alias("title"), one("logsource.product").alias("product"), one("tags").alias("tag")).drop("path")


@query("scan_registered", "SELECT n_nationkey AS id, n_name AS text FROM nation")
def scan_registered(spark, sf):
    """A dataset by its registered name, with its columns renamed; the registry is saved and loaded."""
    path = folder(spark)
    first = I.Registry([])
    first.add(I.Dataset("nations", f"{sf}/nation.parquet", columns={"id": "n_nationkey", "text": "n_name"}))
    first.save(spark, path)
    known = I.Registry.load(spark, path)
    return known.read(spark, known.enabled("nations", [])[0])


@query("sink_append", "SELECT r_regionkey, r_name, 2 AS times FROM region")
def sink_append(spark, sf):
    """Created once, appended once."""
    path = folder(spark)
    for _ in range(2):
        K.append_csv(table(spark, sf, "region").select("r_regionkey", "r_name"), path)
    return I.read_delimited(spark, path, "r_regionkey long, r_name string").groupBy("r_regionkey", "r_name").agg(F.count("*").cast("int").alias("times"))


@query("sink_scrubbed", "SELECT item_id, text FROM benchmark WHERE item_id % 4 <> 0")
def sink_scrubbed(spark, sf):
    """A JSON lines file without its broken lines."""
    source, out = folder(spark), folder(spark)
    b = table(spark, sf, "benchmark")
    b.select(F.when(F.col("item_id") % 4 == 0, "{oops").otherwise(F.to_json(F.struct("item_id", "text"))).alias("value")).write.text(source)
    K.scrub_jsonl(spark, source, "item_id long, text string", out)
    return I.read_jsonl(spark, out, "item_id long, text string")


@query("sink_reports", "SELECT unnest(['json', 'md', 'csv', 'tsv']) AS kind, unnest([6, 7, 6, 6]) AS n_lines")
def sink_reports(spark, sf):
    """Counts of a small table in four report formats."""
    counts = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"))
    lines = [(k, len(K.report_text(counts, k).strip().split("\n")) + (1 if k == "json" else 0)) for k in ("json", "md", "csv", "tsv")]
    return spark.createDataFrame(lines, "kind string, n_lines int")


# ------------------------------------------------------------ renderers


@query("render_cve", "SELECT 'CVE-' || p_partkey AS id, '2024-02-03' AS date, 'CVE-' || p_partkey || ' | Weaknesses: CWE-' || p_size || CASE WHEN p_partkey % 2 = 0 THEN ' | CVSS 3.1 ' || (p_partkey % 10) || '.0 HIGH' ELSE '' END || chr(10) || p_name AS text FROM part WHERE p_partkey % 3 <> 0")
def render_cve(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    lang = lambda x, v: F.struct(F.lit(x).alias("lang"), v.alias("value"))
    none = F.array().cast("array<struct<score:double,severity:string>>")
    rows = p.select(
        F.concat(F.lit("CVE-"), k.cast("string")).alias("id"), F.lit("2024-02-03T01:02:03").alias("published"), F.when(k % 3 == 0, F.array(lang("es", F.col("p_type")))).otherwise(F.array(lang("es", F.col("p_type")), lang("en", F.col("p_name")))).alias("descriptions"),
        F.array(F.struct(F.array(lang("en", F.concat(F.lit("CWE-"), F.col("p_size").cast("string"))), lang("en", F.lit("NVD-CWE-noinfo"))).alias("description"))).alias("weaknesses"),
        F.when(k % 2 == 0, F.array(F.struct((k % 10).cast("double").alias("score"), F.lit("HIGH").alias("severity")))).alias("v31"), none.alias("v30"), none.alias("v2"),
    )
    return R.cve_documents(rows)


@query("render_cwe", "SELECT 'CWE-' || n_nationkey AS id, 'CWE-' || n_nationkey || ' ' || n_name || chr(10) || 'about it' || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || 'more of it' ELSE '' END AS text FROM nation WHERE n_nationkey % 5 <> 0")
def render_cwe(spark, sf):
    k = F.col("n_nationkey")
    return R.cwe_documents(table(spark, sf, "nation").select(k.alias("id"), F.when(k % 5 == 0, "").otherwise(F.col("n_name")).alias("name"), F.lit("about it").alias("description"), F.when(k % 2 == 0, " more\n of   it ").otherwise(" ").alias("extended")))


@query("render_rules", "SELECT n_nationkey AS id, n_name || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN 'Log source: category=x, product=p' || n_regionkey || chr(10) ELSE '' END || 'does it' AS text FROM nation")
def render_rules(spark, sf):
    k = F.col("n_nationkey")
    even = F.create_map(F.lit("category"), F.lit("x"), F.lit("product"), F.concat(F.lit("p"), F.col("n_regionkey").cast("string")), F.lit("service"), F.lit(""))
    return R.rule_documents(table(spark, sf, "nation").select(k.alias("id"), F.col("n_name").alias("title"), F.lit("does it").alias("description"), F.when(k % 2 == 0, even).otherwise(F.create_map(F.lit("product"), F.lit(""))).alias("logsource"), F.array().cast("array<string>").alias("tags")))


@query("report_digests", "SELECT doc_id, substr('id <hash> ' || text, 1, 200) AS digest FROM documents WHERE NOT regexp_matches(text, '[0-9a-fA-F]{32,}')")
def report_digests(spark, sf):
    d = table(spark, sf, "documents").where(~F.col("text").rlike("[0-9a-fA-F]{32,}"))
    return d.select("doc_id", R.report_digest(F.concat(F.lit("id "), F.md5(F.lit("x")), F.lit(" "), "text")).alias("digest"))


# ------------------------------------------------------------ builders and generators


@query("build_cve_weaknesses", "SELECT p_partkey AS src, n_nationkey AS dst FROM part JOIN nation ON n_nationkey = CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 25 ELSE p_size % 25 END")
def build_cve_weaknesses(spark, sf):
    """By the weakness id, else by the first id in the description."""
    k = F.col("p_partkey")
    cves = table(spark, sf, "part").select(k.alias("id"), F.when(k % 2 == 0, F.concat(F.lit("CWE-"), (k % 25).cast("string"))).otherwise("").alias("cwe_id"), F.concat(F.lit("see CWE-"), (F.col("p_size") % 25).cast("string"), F.lit(" and CWE-1")).alias("description"))
    return U.cve_weaknesses(cves, table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("CWE-"), F.col("n_nationkey").cast("string")).alias("cwe_id")))


@query("build_scoped_mitigations", "SELECT 'CWE-' || n_nationkey || '_MIT-' || k AS id, 'CWE-' || n_nationkey AS cwe_id, CASE k WHEN 1 THEN n_name ELSE 'second' END AS text FROM nation, (SELECT unnest([1, 2]) AS k)")
def build_scoped_mitigations(spark, sf):
    return U.scoped_mitigations(table(spark, sf, "nation").select(F.concat(F.lit("CWE-"), F.col("n_nationkey").cast("string")).alias("cwe_id"), F.array("n_name", F.lit("second")).alias("mitigations")))


@query("schema_templates", """SELECT '{x:' || label || '.' || prop || '}' AS template FROM (SELECT DISTINCT 'region' AS label, 'name' AS prop FROM region WHERE r_name IS NOT NULL UNION ALL SELECT DISTINCT 'nation', 'name' FROM nation WHERE n_name IS NOT NULL UNION ALL SELECT DISTINCT 'customer', unnest(['name', 'segment', 'balance']) FROM customer WHERE c_acctbal IS NOT NULL
UNION ALL SELECT DISTINCT 'supplier', 'name' FROM supplier UNION ALL SELECT DISTINCT 'order', unnest(['priority', 'status']) FROM orders)
UNION ALL SELECT DISTINCT '{a:customer.lives_in>b:nation.id}' FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT DISTINCT '{a:nation.home_of>b:customer.id}' FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT DISTINCT '{a:customer.placed>b:order.id}' FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT DISTINCT '{a:nation.part_of>b:region.id}' FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT DISTINCT '{a:supplier.based_in>b:nation.id}' FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def schema_templates(spark, sf):
    """Templates for what the graph's rows have."""
    from kilnspark.operators.graph import star_schema

    g = star_schema(spark, sf)
    return N.schema_templates(g.schema_properties(), g.schema_edges())


@query("merge_tool_turns", "SELECT conv_id, string_agg(CASE WHEN turn % 3 = 0 THEN 'user:' || text ELSE '' END || CASE WHEN turn % 3 = 1 THEN 'tool:' || text ELSE '' END || CASE WHEN turn % 3 = 2 THEN chr(10) || '</tool_response>' || chr(10) || '<tool_response>' || chr(10) || text ELSE '' END, '' ORDER BY turn) AS joined FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def merge_tool_turns(spark, sf):
    """Of each three turns the last two are tool answers and become one."""
    c = table(spark, sf, "conversations").where("text is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.when(F.col("turn") % 3 == 0, "user").otherwise("tool").alias("role"), F.col("text").alias("content")))).alias("m"))
    m = S.merge_tools(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    return c.select("conv_id", F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "").alias("joined"))


@query("render_templates", """WITH c AS (SELECT conv_id, turn, text AS t FROM conversations WHERE text <> '')
SELECT conv_id, turn, 'gemma' AS template, '<bos><start_of_turn>user' || chr(10) || t || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) || 'yes<end_of_turn>' || chr(10) AS chat FROM c UNION ALL SELECT conv_id, turn, 'phi', '<|user|>' || chr(10) || t || '<|end|>' || chr(10) || '<|assistant|>' || chr(10) || 'yes<|end|>' || chr(10) FROM c
UNION ALL SELECT conv_id, turn, 'llama3', '<|begin_of_text|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || t || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || 'yes<|eot_id|>' FROM c UNION ALL SELECT conv_id, turn, 'alpaca', '### Instruction:' || chr(10) || t || chr(10) || chr(10) || '### Response:' || chr(10) || 'yes' || chr(10) || chr(10) FROM c""")
def render_templates(spark, sf):
    c = table(spark, sf, "conversations").where("text <> ''")
    m = F.array(S.message("user", F.col("text")), S.message("assistant", F.lit("yes")))
    each = F.array(*[F.struct(F.lit(n).alias("template"), S.render_chat(m, F.lit(""), n).alias("chat")) for n in ("gemma", "phi", "llama3", "alpaca")])
    return c.select("conv_id", "turn", F.explode(each).alias("x")).select("conv_id", "turn", "x.template", "x.chat")


@query("tokenizer_round_trip", "SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL")
def tokenizer_round_trip(spark, sf):
    """Ids of a tokenizer file, and the text from them again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    c = table(spark, sf, "conversations").where("text is not null")
    return c.select("conv_id", "turn", S.from_tokens(S.file_tokens(F.col("text"), path), path).alias("text"))


@query("encode_file_tokens", "SELECT conv_id, turn, true AS same FROM conversations WHERE text IS NOT NULL")
def encode_file_tokens(spark, sf):
    """Turn pairs encoded with a tokenizer file: labels are the ids wherever they are not ignored."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    c = table(spark, sf, "conversations").where("text is not null").select("conv_id", "turn", S.file_tokens(F.col("role"), path).alias("p"), S.file_tokens(F.col("text"), path).alias("r"))
    x = D.encode_turns(F.array(F.struct(F.col("p").alias("source"), F.col("r").alias("target"))), 64)
    same = F.forall(F.arrays_zip(x["input_ids"].alias("i"), x["labels"].alias("l")), lambda z: (z["l"] == S.IGNORE) | (z["l"] == z["i"])) & (F.size(x["input_ids"]) <= 64)
    return c.select("conv_id", "turn", same.alias("same"))


# ------------------------------------------------------------ streaming


@query("stream_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(spark, sf):
    """Tumbling windows by event time over arriving files; all windows are written at the end."""
    out, state = folder(spark), folder(spark)
    s = T.read_files(spark, f"{sf}/events.parquet*", "event_id long, ts timestamp, event_type string")
    w = T.window_counts(s, "ts", "event_type", "1 hour", "1 hour")
    T.run_available_batches(w, out, state)
    return spark.read.parquet(out)


# ------------------------------------------------------------ published tables


@query("sink_published", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer UNION ALL SELECT -c_custkey, c_acctbal, NULL FROM customer WHERE c_custkey > 0 AND c_custkey % 10 = 0")
def sink_published(spark, sf):
    """Two upserts, one of them delivered again, and a write that dies: readers see the second version."""
    from kilnspark.sources.publish import Published

    out = Published(spark, folder(spark))
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    out.upsert(c, ["c_custkey"], batch=0)
    third = c.where("c_custkey % 3 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    tenth = c.where("c_custkey > 0 AND c_custkey % 10 = 0").select((-F.col("c_custkey")).alias("c_custkey"), "c_acctbal")
    for _ in range(2):
        out.upsert(third.unionByName(tenth), ["c_custkey"], batch=1)
    try:
        broken = c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 == 0, F.raise_error(F.lit("dies"))).otherwise(F.col("c_acctbal")))
        out.upsert(broken, ["c_custkey"], batch=2, tries=1)
        raise AssertionError("the write should die")
    except AssertionError:
        raise
    except Exception:  # noqa: S110  the old version is what this query shows
        pass
    return out.read()


@query("sink_scrubbed_lines", "SELECT DISTINCT conv_id, turn FROM conversations WHERE turn % 5 <> 4")
def sink_scrubbed_lines(spark, sf):
    """Every fifth line is cut off; the rest is published in its place."""
    from kilnspark.sources.publish import Published, scrub_lines

    lines = Published(spark, folder(spark), "text")
    c = table(spark, sf, "conversations")
    whole = F.to_json(F.struct("conv_id", "turn", "text"))
    lines.publish(c.select(F.when(F.col("turn") % 5 == 4, F.substring(whole, 1, 20)).otherwise(whole).alias("value")))
    scrub_lines(lines)
    return lines.read().select(F.from_json("value", "conv_id long, turn long").alias("x")).select("x.*").distinct()


def _archive(docs):
    """One group's documents in an archive, every third one in an archive within it."""
    import pandas as pd

    data, within = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        with zipfile.ZipFile(within, "w") as w:
            for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
                (w if doc_id % 3 == 0 else z).writestr(f"d/{doc_id}.txt", text or "")
                z.writestr(f"d/{doc_id}.skip", "no")
        z.writestr("more.zip", within.getvalue())
    return pd.DataFrame([(int(docs["part"].iloc[0]), data.getvalue())], columns=["part", "data"])


@query("scan_nested_archives", "SELECT doc_id, strlen(text) AS n_bytes, doc_id % 3 = 0 AS inside FROM documents")
def scan_nested_archives(spark, sf):
    """All documents in archives of 64, made and unzipped in tasks; archives within archives are read through."""
    from kilnspark.sources.archives import walk

    docs = table(spark, sf, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / 64).alias("part"))
    made = docs.groupBy("part").applyInPandas(_archive, "part long, data binary")

    def members(batches):
        import pyarrow as pa

        for given in batches:
            for data in given.column("data").to_pylist():
                rows = [(m, len(c)) for m, c in walk(io.BytesIO(data), lambda m: m.endswith(".txt"))]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["member", "n_bytes"])

    found = made.mapInArrow(members, "member string, n_bytes long")
    return found.select(F.regexp_extract("member", r"d/(\d+)\.txt$", 1).cast("long").alias("doc_id"), "n_bytes", F.col("member").startswith("more.zip!/").alias("inside"))


@query("report_truncated", """WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[^A-Za-z ]+', '', 'g')) AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, '{"submit_name": "' || t || ' hash", "processes": [{"name": "hash.exe", "cafe0123456789abcdef0123456789abcdef": ["hash", 7]}], "mitre_attcks": [' || CASE WHEN doc_id % 2 = 0 THEN '{"tactic": "T", "technique": "{x}, [y]"}, {"attck_id": "T1"}' ELSE '' END || '], "signatures": [' || CASE WHEN doc_id % 3 <> 0 THEN '{"name": "s", "description": "' || substr(t, 1, 50) || '"}, {"level": 2}' ELSE '' END || ']}' AS report FROM t""")
def report_truncated(spark, sf):
    """A report made of each document: keys out of order, others in between, hashes, nested lists."""
    h = "0123456789abcdef0123456789abcdef01"
    t = F.trim(F.regexp_replace("text", "[^A-Za-z ]+", ""))
    d = table(spark, sf, "documents").where("text is not null").withColumn("t", t)
    some = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('"mitre_attcks":[{"extra":{"a":[1]},"technique":"{x}, [y]","tactic":"T"},{"attck_id":"T1"}],'))).otherwise("")
    signs = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit('"signatures":[{"name":"s","description":"'), "t", F.lit('"},{"level":2}],'))).otherwise(F.when(F.col("doc_id") % 2 == 0, '"signatures":[],').otherwise('"mitre_attcks":[],"signatures" : [ ],'))
    report = F.concat(F.lit("{"), signs, F.lit(f'"noise":"{h}",'), some, F.lit(f'"processes":[{{"name":"{h}.exe","cafe{h[:-2]}":["{h}",7]}}],"submit_name":"'), "t", F.lit(f' {h}"'), F.when((F.col("doc_id") % 2 == 1) & (F.col("doc_id") % 3 != 0), ',"mitre_attcks":[]').otherwise(""), F.lit("}"))
    return R.truncated_reports(d.select("doc_id", report.alias("raw")), F.col("raw")).select("doc_id", "report")


@query("stream_sliding", "SELECT w AS start, event_type, count(*) AS n FROM (SELECT event_type, date_trunc('hour', ts) - to_hours(unnest([0, 1, 2])::INTEGER) AS w FROM events) GROUP BY ALL")
def stream_sliding(spark, sf):
    """Extension: each event counts in the three windows of three hours that hold it."""
    out, state = folder(spark), folder(spark)
    s = T.read_files(spark, f"{sf}/events.parquet*", "event_id long, ts timestamp, event_type string")
    T.run_available_batches(T.window_counts(s, "ts", "event_type", "3 hours", "1 hour", "1 hour"), out, state)
    return spark.read.parquet(out)


@query("stream_sessions", """WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
SELECT min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, session""")
def stream_sessions(spark, sf):
    """Extension: a user's events less than six hours apart."""
    out, state = folder(spark), folder(spark)
    s = T.read_files(spark, f"{sf}/events.parquet*", "event_id long, ts timestamp, user_id long")
    T.run_available_batches(T.session_counts(s, "ts", "user_id", "6 hours", "1 hour"), out, state)
    return spark.read.parquet(out)
