"""Queries of sample construction, sources, sinks and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.operators import samples as S
from kilnspark.registry import query, table
from kilnspark.sources import readers as R
from kilnspark.sources import sinks as K
from kilnspark.sources.workspace import folder
from kilnspark.streaming import buffers as B
from kilnspark.streaming import ingest as I


def _conversations(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return c.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))


@query("align_alpaca", "SELECT conv_id, turn, 1 AS prompt_turns, CASE WHEN turn % 2 = 0 THEN role || chr(10) || text ELSE role END AS prompt, text AS response FROM conversations")
def align_alpaca(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.col("role").alias("instruction"), F.when(F.col("turn") % 2 == 0, F.col("text")).alias("input"), F.col("text").alias("output"))
    first = lambda m: F.element_at(m, 1)["content"]
    return S.align_alpaca(c).select("conv_id", "turn", F.size("_prompt").alias("prompt_turns"), first("_prompt").alias("prompt"), first("_response").alias("response"))


_BODY = """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE role <> 'system'), c AS (SELECT conv_id, count(*) AS n, bool_and(CASE WHEN i % 2 = 0 THEN role IN ('user', 'observation') ELSE role IN ('assistant', 'function') END) AS fits FROM t GROUP BY conv_id)"""


@query("align_messages", _BODY + " SELECT conv_id, CASE WHEN fits AND n % 2 = 0 THEN n - 1 ELSE 0 END AS prompt_turns, CASE WHEN fits AND n % 2 = 0 THEN 1 ELSE 0 END AS response_turns FROM c")
def align_messages(spark, sf):
    a = S.align_messages(_conversations(spark, sf), "messages")
    return a.select("conv_id", F.size("_prompt").cast("long").alias("prompt_turns"), F.size("_response").alias("response_turns"))


@query("render_chatml", """SELECT conv_id, string_agg(CASE role WHEN 'system' THEN '<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10) WHEN 'user' THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) ELSE text || '<|im_end|>' || chr(10) END, '' ORDER BY turn) AS chat
FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING min(text) <> '') GROUP BY conv_id""")
def render_chatml(spark, sf):
    c = _conversations(spark, sf)
    lead = F.element_at("messages", 1)
    system = F.when(lead["role"] == "system", lead["content"])
    body = F.filter("messages", lambda m: m["role"] != "system")
    return c.where(F.forall("messages", lambda m: m["content"] != "")).select("conv_id", S.render_chat(body, system, "chatml").alias("chat"))


@query("encode_supervised", """WITH r AS (SELECT doc_id, strlen(lang) * 40 AS s, strlen(source) * 30 AS t FROM documents), k AS (SELECT *, least(CASE WHEN t * 2 < 199 THEN 199 WHEN s * 2 < 199 THEN 199 - s ELSE floor(199 * t / (s + t)::DOUBLE) END, t)::BIGINT AS nt FROM r)
SELECT doc_id, least(greatest(199 - nt, 0), s) + nt + 1 AS n_ids, nt + 1 AS n_labels FROM k""")
def encode_supervised(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", S.byte_tokens(F.repeat("lang", F.lit(40))).alias("p"), S.byte_tokens(F.repeat("source", F.lit(30))).alias("r"))
    ids, labels = S.encode_supervised(F.col("p"), F.col("r"), 200)
    return d.select("doc_id", F.size(ids).cast("long").alias("n_ids"), F.size(F.filter(labels, lambda x: x != S.IGNORE)).cast("long").alias("n_labels"))


_BYTES_SQL = "list_transform(range(0, strlen({x})), lambda p: CAST('0x' || substr(hex(encode({x})), 2 * p + 1, 2) AS INT) + 3)"


@query("encode_pairwise", f"""WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(lead(text) OVER w, '') AS chosen, coalesce(lag(text) OVER w, '') AS rejected FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT conv_id, turn, {_BYTES_SQL.format(x="text")} AS p, {_BYTES_SQL.format(x="chosen")} AS c, {_BYTES_SQL.format(x="rejected")} AS r FROM c), l AS (SELECT *, len(p) AS s, greatest(len(c), len(r)) AS t FROM r),
k AS (SELECT *, least(CASE WHEN t * 2 < 600 THEN 600 WHEN s * 2 < 600 THEN 600 - s ELSE floor(600 * t / (s + t)::DOUBLE) END, t)::BIGINT AS m FROM l), b AS (SELECT *, p[1:least(greatest(600 - m, 0), s)] AS q FROM k)
SELECT conv_id, turn, md5(array_to_string(list_concat(q, c[1:m]), ',')) AS chosen, md5(array_to_string(list_concat(list_transform(q, lambda x: -100), c[1:m]), ',')) AS chosen_labels, md5(array_to_string(list_concat(q, r[1:m]), ',')) AS rejected, md5(array_to_string(list_concat(list_transform(q, lambda x: -100), r[1:m]), ',')) AS rejected_labels FROM b""")
def encode_pairwise(spark, sf):
    """A turn as prompt, the next one as the chosen and the one before as the rejected response."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.lead("text").over(w), F.lit("")).alias("chosen"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("rejected"))
    t = c.select("conv_id", "turn", *[S.byte_tokens(F.col(x)).alias(x) for x in ("text", "chosen", "rejected")])
    found = S.encode_pair(F.col("text"), F.col("chosen"), F.col("rejected"), 600)
    return t.select("conv_id", "turn", *[F.md5(F.array_join(x, ",")).alias(n) for x, n in zip(found, ("chosen", "chosen_labels", "rejected", "rejected_labels"), strict=True)])


@query("pad_truncate", "SELECT doc_id, list_concat(list_transform(range(1, 1 + least(6, doc_id % 9)), lambda x: x::INT), list_transform(range(0, greatest(0, 6 - doc_id % 9)), lambda x: -100)) AS padded FROM documents")
def pad_truncate(spark, sf):
    n = (F.col("doc_id") % 9).cast("int")
    values = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return table(spark, sf, "documents").select("doc_id", S.pad(values, 6, S.IGNORE).alias("padded"))


@query("block_packing", "WITH d AS (SELECT doc_id // 50 AS grp, sum(doc_id % 7) AS n FROM documents GROUP BY 1) SELECT grp, CAST(n // 16 AS BIGINT) AS blocks FROM d WHERE n >= 16")
def block_packing(spark, sf):
    n = (F.col("doc_id") % 7).cast("int")
    d = table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 50).alias("grp"), F.array_repeat(F.lit(5), n).alias("t"))
    return S.block_pack(d, "grp", "doc_id", "t", 16, bos=1).groupBy("grp").agg(F.count("*").alias("blocks"))


@query("knapsack_packing")
def knapsack_packing(spark, sf):
    """Greedy packing by shard: tests check that bins hold their capacity and every row once."""
    return S.knapsack(table(spark, sf, "documents"), "doc_id", "n_chars", 20_000, F.floor(F.col("doc_id") / 1000))


@query("data_parallel_batches", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents) SELECT doc_id, k // 24 AS global_batch, k % 24 // 12 AS rank, k % 24 % 12 // 4 AS micro FROM r WHERE k // 24 < (SELECT count(*) // 24 FROM documents)")
def data_parallel_batches(spark, sf):
    return S.batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 2, 4, 3)


@query("stitch_contexts", """WITH r AS (SELECT doc_id, text, md5('st|' || doc_id) AS h, CAST('0x' || substring(md5('st|' || doc_id), 1, 8) AS BIGINT) % 20 AS grp FROM documents WHERE text IS NOT NULL), u AS (SELECT *, CAST(floor((sum(length(text)) OVER (PARTITION BY grp ORDER BY h, doc_id) - 1) / 60000) AS BIGINT) AS part FROM r)
SELECT grp, part, n_rows, question_of, md5(context) AS context_md5 FROM (SELECT grp, part, count(*)::INT AS n_rows, arg_max(doc_id, struct_pack(n := length(text), d := doc_id)) AS question_of, string_agg(text, chr(10) || chr(10) ORDER BY h, doc_id) AS context FROM u GROUP BY grp, part) WHERE length(context) >= 5000""")
def stitch_contexts(spark, sf):
    return S.stitch(table(spark, sf, "documents"), "doc_id", "text", 5000, 60000, "st", 20).select("grp", "part", "n_rows", "question_of", F.md5("context").alias("context_md5"))


@query("prompt_building", "SELECT doc_id, 'Name the language of ' || source || ' item ' || doc_id || '. Answer with one word.' AS prompt, lang AS answer FROM documents")
def prompt_building(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.format_string("Name the language of %s item %d. Answer with one word.", "source", "doc_id").alias("prompt"), F.col("lang").alias("answer"))


# ------------------------------------------------------------ sources and sinks


@query("scan_jsonl", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 10 <> 0")
def scan_jsonl(spark, sf):
    """JSON lines with malformed ones among them."""
    path = folder(spark)
    d = table(spark, sf, "documents")
    d.select(F.when(F.col("doc_id") % 10 == 0, "{broken").otherwise(F.to_json(F.struct("doc_id", "lang", "n_chars"))).alias("value")).write.text(path)
    return R.read_jsonl(spark, path, "doc_id long, lang string, n_chars long")


@query("scan_csv", "SELECT item_id, text FROM benchmark")
def scan_csv(spark, sf):
    path = folder(spark)
    table(spark, sf, "benchmark").write.option("header", True).option("escape", '"').csv(path)
    return R.read_delimited(spark, path, "item_id long, text string")


@query("scan_gzip_json", "SELECT item_id, text FROM benchmark")
def scan_gzip_json(spark, sf):
    path = folder(spark)
    table(spark, sf, "benchmark").write.option("compression", "gzip").json(path)
    return R.read_jsonl(spark, path, "item_id long, text string")


@query("scan_xml", "SELECT c_custkey, c_name FROM customer")
def scan_xml(spark, sf):
    path = folder(spark)
    table(spark, sf, "customer").select("c_custkey", "c_name").write.format("xml").option("rowTag", "customer").save(path)
    return R.read_xml(spark, path, "customer", "c_custkey long, c_name string")


@query("scan_event_props", "SELECT event_type, count(*) AS n, count(props) AS with_props FROM events GROUP BY event_type")
def scan_event_props(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.try_parse_json("props"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("p").alias("with_props"))


@query("sink_corpus", "SELECT text FROM documents")
def sink_corpus(spark, sf):
    path = folder(spark)
    K.write_corpus(table(spark, sf, "documents"), path)
    return R.read_jsonl(spark, path, "text string")


@query("sink_merge_keyed", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def sink_merge_keyed(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return K.merge_keyed(c, c.where("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("new")), ["c_custkey"])


@query("sink_token_cache", "SELECT doc_id, strlen(lang) AS n FROM documents")
def sink_token_cache(spark, sf):
    root = folder(spark)
    build = lambda: table(spark, sf, "documents").select("doc_id", F.size(S.byte_tokens(F.col("lang"))).cast("long").alias("n"))
    K.cached(spark, root, {"tokenizer": "bytes"}, build)
    return K.cached(spark, root, {"tokenizer": "bytes"}, lambda: None)


# ------------------------------------------------------------ streaming


@query("stream_curate", r"""SELECT doc_id, CASE WHEN CAST('0x' || substring(md5('w|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.1 THEN 'val' ELSE 'train' END AS split FROM documents
WHERE length(text) BETWEEN 100 AND 200000 AND length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / length(text) >= 0.85 AND len(regexp_extract_all(text, '[A-Za-z]{2,}')) >= 15""")
def stream_curate(spark, sf):
    """The batch filter and split over arriving files, to a table; a second run finds nothing new."""
    out, state = folder(spark), folder(spark)
    for _ in range(2):
        s = I.read_files(spark, f"{sf}/documents.parquet*", "doc_id long, text string")
        I.run_available(I.hash_split(I.curate_stream(s), "doc_id", 0.1, "w").select("doc_id", "split"), out, state)
    return spark.read.schema("doc_id long, split string").parquet(out)


@query("stream_token_batches", """SELECT shard, (spot // 8)::BIGINT AS batch, (spot % 8)::INTEGER AS place, doc_id, coalesce(len(tokens), 0)::BIGINT AS n_tokens, coalesce(list_sum(tokens), 0)::BIGINT AS total FROM (
SELECT doc_id % 16 AS shard, doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) AS tokens, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id) - 1 AS spot, count(*) OVER (PARTITION BY doc_id % 16) AS n FROM documents)
WHERE spot < n // 8 * 8""")
def stream_token_batches(spark, sf):
    """Samples arrive in two lots; the second run takes up the buffers that the first one left."""
    docs = table(spark, sf, "documents").select((F.col("doc_id") % 16).alias("shard"), F.col("doc_id").alias("position"), F.transform(F.split("text", " "), lambda w: F.length(w)).alias("tokens"))
    half = docs.agg((F.min("position") + F.max("position")) / 2).first()[0] or 0
    landing, out, state = folder(spark), folder(spark), folder(spark)
    for lot in (F.col("position") <= half, F.col("position") > half):
        docs.where(lot).write.mode("append").parquet(landing)
        B.run_batches(I.read_files(spark, landing, "shard long, position long, tokens array<int>"), out, state, 8)
    given = spark.read.schema(B.BATCHES).parquet(out)
    return given.select("shard", "batch", "place", F.col("position").alias("doc_id"), F.size("tokens").cast("long").alias("n_tokens"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("stitch_drawn", """WITH pool AS (SELECT doc_id, text, lang, source, length(text) AS len, row_number() OVER (ORDER BY doc_id) - 1 AS spot FROM documents WHERE length(text) > 0), size AS (SELECT count(*) AS n FROM pool),
slots AS (SELECT c.range AS context, a.range AS attempt, CASE WHEN a.range = 24 THEN 9 ELSE 3 + CAST('0x' || substring(md5('sd|' || c.range || '|' || a.range || '|n'), 1, 15) AS BIGINT) % 7 END AS wanted FROM (SELECT unnest(range(CAST((SELECT n FROM size) // 10 AS BIGINT))) AS range) c, range(25) a),
hashed AS (SELECT context, attempt, wanted, j, CAST('0x' || substring(md5('sd|' || context || '|' || attempt || '|' || j), 1, 15) AS BIGINT) % (SELECT n FROM size) AS spot FROM (SELECT *, unnest(range(8 * wanted)) AS j FROM slots)),
firsts AS (SELECT context, attempt, any_value(wanted) AS wanted, spot, min(j) AS h FROM hashed GROUP BY context, attempt, spot),
drawn AS (SELECT context, attempt, spot, row_number() OVER (PARTITION BY context, attempt ORDER BY h) - 1 AS j FROM firsts QUALIFY j < wanted),
sums AS (SELECT context, attempt, sum(len)::BIGINT AS chars FROM drawn JOIN pool USING (spot) GROUP BY ALL),
chosen AS (SELECT context, min(attempt) AS attempt FROM sums WHERE chars BETWEEN 4000 AND 9000 OR attempt = 24 GROUP BY 1),
held AS (SELECT d.context, d.attempt, s.chars, d.j, p.* FROM chosen c JOIN drawn d ON d.context = c.context AND d.attempt = c.attempt JOIN sums s ON s.context = c.context AND s.attempt = c.attempt JOIN pool p ON p.spot = d.spot)
SELECT context, attempt::INTEGER AS attempt, count(*)::INTEGER AS n_rows, any_value(chars) AS chars, arg_min(doc_id, struct_pack(l := -len, j := j)) AS question_of,
  md5('THREAT INTELLIGENCE REPORT' || chr(10) || repeat('=', 60) || string_agg(chr(10) || 'SECTION ' || (j + 1) || ' (' || source || ')' || chr(10) || repeat('-', 60) || chr(10) || trim(text), '' ORDER BY j) || chr(10) || chr(10) || 'QUESTION' || chr(10) || repeat('-', 60) || chr(10) || arg_min(lang, struct_pack(l := -len, j := j))) AS report_md5 FROM held GROUP BY ALL""")
def stitch_drawn(spark, sf):
    """One context for ten documents; the first of 24 draws of three to nine rows with 4,000 to 9,000 characters."""
    docs = table(spark, sf, "documents")
    out = S.drawn_contexts(docs, "doc_id", "text", "source", "lang", docs.where("length(text) > 0").count() // 10, "sd", (3, 9), (4000, 9000))
    return out.select("context", "attempt", "n_rows", "chars", "question_of", F.md5("report").alias("report_md5"))


@query("batched_map", "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_words FROM documents WHERE len(string_split(text, ' ')) > 20")
def batched_map(spark, sf):
    """A function over dictionaries of lists that keeps some rows of each batch."""
    from kilnspark.sources.readers import batched_map as mapped

    def longer(batch):
        counts = [len(t.split(" ")) if t is not None else 0 for t in batch["text"]]
        kept = [i for i, n in enumerate(counts) if n > 20]
        return {"doc_id": [batch["doc_id"][i] for i in kept], "n_words": [counts[i] for i in kept]}

    return mapped(table(spark, sf, "documents").select("doc_id", "text"), longer, "doc_id long, n_words long", 100)
