"""Queries of multi-turn samples over the conversations table; ids and labels are compared themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.operators import dialogue as D
from kilnspark.operators import samples as S
from kilnspark.plans.sample_queries import _conversations
from kilnspark.registry import query, table

# conversations whose turns alternate; texts in the slots of chatml, as byte tokens plus 3
_TURNS = """b AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role <> 'system'),
f AS (SELECT conv_id, max(n) AS n FROM b GROUP BY conv_id HAVING bool_and(CASE WHEN i % 2 = 0 THEN role = 'user' ELSE role = 'assistant' END) AND max(n) % 2 = 0),
sys AS (SELECT conv_id, arg_min(role, turn) AS r, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id),
w AS (SELECT b.conv_id, b.i, CASE WHEN b.i % 2 = 0 THEN CASE WHEN b.i = 0 AND s.r = 'system' AND s.text <> '' THEN '<|im_start|>system' || chr(10) || s.text || '<|im_end|>' || chr(10) ELSE '' END || '<|im_start|>user' || chr(10) || b.text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) ELSE b.text || '<|im_end|>' || chr(10) END AS t
  FROM b JOIN f USING (conv_id) JOIN sys s USING (conv_id)),
k AS (SELECT conv_id, i, list_transform(range(0, strlen(t)), lambda p: CAST('0x' || substr(hex(encode(t)), 2 * p + 1, 2) AS INT) + 3) AS ids FROM w),
p AS (SELECT a.conv_id, a.i // 2 AS k, a.ids AS s, c.ids AS t, max(a.i // 2) OVER (PARTITION BY a.conv_id) AS last FROM k a JOIN k c ON a.conv_id = c.conv_id AND a.i + 1 = c.i AND a.i % 2 = 0)"""


def _fold(order: str, cutoff: int, start: int) -> str:
    """Recursive budgets of the pairs; ``order`` is the pair's place in the order they are taken in."""
    budget = f"({cutoff} - total)"
    m = f"least(CASE WHEN 2 * len(t) < {budget} THEN {budget} WHEN 2 * len(s) < {budget} THEN {budget} - len(s) ELSE CAST(floor({budget} * len(t) / CAST(len(s) + len(t) AS DOUBLE)) AS BIGINT) END, len(t))"
    return f"""q AS (SELECT conv_id, {order} AS k, s, t FROM p),
g AS (SELECT conv_id, 0 AS k, CAST({start} AS BIGINT) AS total, CAST([] AS INT[]) AS s, CAST([] AS INT[]) AS t FROM q WHERE k = 0
  UNION ALL SELECT conv_id, k, total + n + m, s[:n], t[:m] FROM (SELECT *, CAST(least(greatest({budget} - m, 0), len(s)) AS BIGINT) AS n FROM (SELECT q.conv_id, q.k + 1 AS k, q.s, q.t, g.total, CAST({m.replace("len(t)", "len(q.t)").replace("len(s)", "len(q.s)")} AS BIGINT) AS m FROM g JOIN q ON g.conv_id = q.conv_id AND g.k = q.k WHERE g.total < {cutoff})))"""


def _aligned(spark, sf):
    c = S.align_messages(_conversations(spark, sf), "messages").where(F.size("_prompt") > 0)
    return c.where(F.forall("messages", lambda m: m["role"].isin("system", "user", "assistant"))).withColumn("m", F.concat("_prompt", "_response"))


_TEXT = "array_to_string({}, ' ')"


@query("encode_multiturn", f"""WITH RECURSIVE {_TURNS}, {_fold("k", 300, 1)}
SELECT conv_id, {_TEXT.format("list_append(flatten(list(list_concat(s, t) ORDER BY k)), 2)")} AS input_ids, {_TEXT.format("list_append(flatten(list(list_concat(list_transform(range(0, len(s)), lambda x: CASE WHEN x = 0 AND k > 1 THEN 2 ELSE -100 END), t) ORDER BY k)), 2)")} AS labels FROM g GROUP BY conv_id""")
def encode_multiturn(spark, sf):
    """All turn pairs up to 300 tokens, an end token between them."""
    e = _aligned(spark, sf).select("conv_id", D.encode_turns(D.turn_pairs(F.col("m"), F.col("_system"), "chatml"), 300, eos=2).alias("x"))
    return e.select("conv_id", *[F.array_join(F.col("x")[c].cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")])


@query("encode_last_turns", f"""WITH RECURSIVE {_TURNS}, {_fold("last - k", 220, 0)}
SELECT conv_id, {_TEXT.format("flatten(list(list_concat(s, t) ORDER BY k DESC))")} AS input_ids, {_TEXT.format("flatten(list(list_concat(list_transform(s, lambda x: -100), CASE WHEN k > 1 THEN list_transform(t, lambda x: -100) ELSE t END) ORDER BY k DESC))")} AS labels FROM g GROUP BY conv_id""")
def encode_last_turns(spark, sf):
    """The last turns first, trained on the last answer alone."""
    e = _aligned(spark, sf).select("conv_id", D.encode_turns(D.turn_pairs(F.col("m"), F.col("_system"), "chatml"), 220, mask_history=True).alias("x"))
    return e.select("conv_id", *[F.array_join(F.col("x")[c].cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")])


_ONE = """o AS (SELECT conv_id, flatten(list(CASE WHEN k = last THEN s ELSE list_concat(s, t) END ORDER BY k)) AS s, max_by(t, k) AS t FROM p GROUP BY conv_id),
c AS (SELECT conv_id, s, t, CAST(least(CASE WHEN 2 * len(t) < 256 THEN 256 WHEN 2 * len(s) < 256 THEN 256 - len(s) ELSE CAST(floor(256 * len(t) / CAST(len(s) + len(t) AS DOUBLE)) AS BIGINT) END, len(t)) AS BIGINT) AS m FROM o),
e AS (SELECT conv_id, s[:least(greatest(256 - m, 0), len(s))] AS s, t[:m] AS t FROM c)"""


@query("encode_unsupervised", f"WITH {_TURNS}, {_ONE} SELECT conv_id, {_TEXT.format('s')} AS input_ids, {_TEXT.format('t')} AS labels FROM e")
def encode_unsupervised(spark, sf):
    e = _aligned(spark, sf).select("conv_id", D.encode_unsupervised(D.turn_pairs(F.col("m"), F.col("_system"), "chatml"), 256).alias("x"))
    return e.select("conv_id", *[F.array_join(F.col("x")[c].cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")])


@query("encode_feedback", f"WITH {_TURNS}, {_ONE} SELECT conv_id, conv_id % 2 = 0 AS desired, {_TEXT.format('list_concat(s, t)')} AS input_ids, {_TEXT.format('list_concat(list_transform(s, lambda x: -100), t)')} AS labels FROM e")
def encode_feedback(spark, sf):
    """Answers of even conversations are desired; the twin of a row is the row itself here."""
    a = _aligned(spark, sf)
    r = D.feedback_responses(F.get("_response", F.lit(0))["content"], F.col("conv_id") % 2 == 0)
    e = a.withColumn("r", r).select("conv_id", D.encode_feedback(F.col("_prompt"), F.col("r"), F.col("r"), F.col("_system"), "chatml", 256).alias("x"))
    return e.select("conv_id", F.col("x.desired").alias("desired"), *[F.array_join(F.col("x")[c].cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")])


@query("ranking_responses", "SELECT conv_id, turn, [text, role] AS ranking, CASE WHEN turn % 2 = 0 THEN [text, ''] ELSE ['', text] END AS feedback FROM conversations")
def ranking_responses(spark, sf):
    content = lambda c: F.transform(c, lambda m: m["content"])
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", content(D.ranking_responses(F.col("text"), F.col("role"))).alias("ranking"), content(D.feedback_responses(F.col("text"), F.col("turn") % 2 == 0)).alias("feedback"))


@query("render_loss_weights", """WITH t AS (SELECT conv_id, turn, role, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS s FROM conversations),
k AS (SELECT *, list_transform(range(0, strlen(s)), lambda p: CAST('0x' || substr(hex(encode(s)), 2 * p + 1, 2) AS INT) + 3) AS ids FROM t)
SELECT conv_id, array_to_string(flatten(list(ids ORDER BY turn)), ' ') AS input_ids, array_to_string(flatten(list(CASE WHEN role = 'assistant' THEN ids ELSE list_transform(ids, lambda x: -100) END ORDER BY turn)), ' ') AS labels, CAST(sum(CASE WHEN role = 'assistant' THEN len(ids) ELSE 0 END) AS DOUBLE) AS weight FROM k GROUP BY conv_id""")
def render_loss_weights(spark, sf):
    x = _conversations(spark, sf).select("conv_id", D.render_weighted(D.weigh_messages(F.col("messages"))).alias("x"))
    weight = F.aggregate("x.loss_weights", F.lit(0.0), lambda a, w: a + w)
    return x.select("conv_id", *[F.array_join(F.col("x")[c].cast("array<string>"), " ").alias(c) for c in ("input_ids", "labels")], weight.alias("weight"))


@query("render_preference", """WITH d AS (SELECT item_id, '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10) AS a, '<|im_start|>assistant' || chr(10) || item_id || '<|im_end|>' || chr(10) AS b FROM benchmark)
SELECT item_id, strlen(a) + strlen(b) AS n_ids, strlen(a) AS chosen, 2 * strlen(b) + strlen(a) AS kinds FROM d""")
def render_preference(spark, sf):
    one = lambda c: D.weigh_alpaca(F.lit(None).cast("string"), F.lit(None).cast("string"), c)
    x = table(spark, sf, "benchmark").select("item_id", D.render_pair(one(F.col("text")), one(F.col("item_id").cast("string"))).alias("x"))
    kinds = F.aggregate("x.token_type_ids", F.lit(0).cast("long"), lambda a, k: a + k)
    return x.select("item_id", F.size("x.input_ids").cast("long").alias("n_ids"), F.size(F.filter("x.token_type_ids", lambda k: k == 1)).cast("long").alias("chosen"), kinds.alias("kinds"))


@query("weigh_alpaca", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'assistant:' || text || ':1.0' WHEN doc_id % 3 = 1 THEN 'system:' || source || ':0.0;user:' || lang || ':0.0;assistant:' || text || ':1.0' ELSE 'system:' || source || ':0.0;user:' || lang || source || ':0.0;assistant:' || text || ':1.0' END AS messages FROM documents WHERE text IS NOT NULL")
def weigh_alpaca(spark, sf):
    k = F.col("doc_id") % 3
    d = table(spark, sf, "documents").where("text is not null")
    m = D.weigh_alpaca(F.when(k > 0, F.col("lang")), F.when(k > 1, F.col("source")), F.col("text"), F.when(k > 0, F.col("source")))
    return d.select("doc_id", F.array_join(F.transform(m, lambda x: F.concat_ws(":", x["role"], x["content"], x["loss_weight"].cast("string"))), ";").alias("messages"))


@query("weigh_shared", """WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'other' WHEN role = 'user' THEN 'human' WHEN role = 'assistant' AND turn % 4 = 2 THEN 'function_call' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS tag, CASE WHEN role = 'assistant' AND turn % 4 = 2 AND conv_id % 2 = 0 THEN '{"name": 1}' ELSE text END AS v FROM conversations)
SELECT conv_id, string_agg(CASE WHEN tag = 'human' THEN 'user' WHEN tag = 'system' THEN 'system' ELSE 'assistant' END || '|' || v || CASE WHEN tag IN ('gpt', 'function_call') THEN '|1.0' ELSE '|0.0' END, ';' ORDER BY turn) AS messages FROM t WHERE tag <> 'other' AND (tag <> 'function_call' OR conv_id % 2 = 0) GROUP BY conv_id""")
def weigh_shared(spark, sf):
    """Calls of odd conversations are prose and no JSON: they are left out."""
    c = table(spark, sf, "conversations")
    call = (F.col("role") == "assistant") & (F.col("turn") % 4 == 2)
    tag = F.when(F.col("turn") % 5 == 4, "other").when(F.col("role") == "user", "human").when(call, "function_call").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    value = F.when(call & (F.col("conv_id") % 2 == 0), '{"name": 1}').otherwise(F.col("text"))
    t = c.select("conv_id", "turn", tag.alias("from"), value.alias("value")).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "from", "value"))).alias("t"))
    m = t.select("conv_id", D.weigh_shared(F.transform("t", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))).alias("m")).where(F.size("m") > 0)
    return m.select("conv_id", F.array_join(F.transform("m", lambda x: F.concat_ws("|", x["role"], x["content"], x["loss_weight"].cast("string"))), ";").alias("messages"))


@query("reason_thoughts", """SELECT conv_id, turn, '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || text AS added, text AS removed FROM conversations WHERE text NOT LIKE chr(10) || '%'""")
def reason_thoughts(spark, sf):
    """Thoughts put in and taken out again."""
    c = table(spark, sf, "conversations").where(~F.col("text").startswith("\n"))
    thought = F.concat(F.lit("<think>\n"), F.col("role"), F.lit("\nand more\n</think>\n\n"), F.col("text"))
    return c.select("conv_id", "turn", D.add_thought(F.col("text")).alias("added"), D.remove_thought(thought).alias("removed"))


@query("reason_messages", """WITH t AS (SELECT conv_id, turn, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n, text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, string_agg(CASE WHEN i = n - 1 AND i % 2 = 0 THEN '<think>' || chr(10) || 'so' || chr(10) || '</think>' || chr(10) || chr(10) || text WHEN i = n - 1 THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) WHEN i % 2 = 1 THEN ltrim(text, chr(10)) ELSE '<think>' || chr(10) || 'so' || chr(10) || '</think>' || chr(10) || chr(10) || text END, ';' ORDER BY turn) AS texts FROM t GROUP BY conv_id""")
def reason_messages(spark, sf):
    c = _conversations(spark, sf)
    m = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.concat(F.lit("<think>\nso\n</think>\n\n"), m["content"]).alias("content")))
    return c.withColumn("m", m).select("conv_id", F.array_join(F.transform(D.reason_messages(F.col("m"), False), lambda x: x["content"]), ";").alias("texts"))


@query("packed_samples")
def packed_samples(spark, sf):
    """Samples of conversations in bins of 2048 tokens; tests take each bin apart again."""
    e = _aligned(spark, sf).select("conv_id", D.encode_turns(D.turn_pairs(F.col("m"), F.col("_system"), "chatml"), 1024).alias("x")).select("conv_id", "x.*")
    bins = S.knapsack(e.withColumn("n", F.size("input_ids")), "conv_id", "n", 2048, F.floor(F.col("conv_id") / 1000))
    return D.pack_encoded(e, bins, "conv_id", 2048, neat=True)


@query("pad_batches", """WITH r AS (SELECT item_id, item_id // 8 AS batch, list_transform(range(0, strlen(text)), lambda p: CAST('0x' || substr(hex(encode(text)), 2 * p + 1, 2) AS INT) + 3) AS ids FROM benchmark),
m AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch) / 8.0) * 8 AS BIGINT) AS n FROM r)
SELECT item_id, array_to_string(list_concat(ids, list_transform(range(0, n - len(ids)), lambda x: 0)), ' ') AS ids FROM m""")
def pad_batches(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", F.floor(F.col("item_id") / 8).alias("batch"), S.byte_tokens(F.col("text")).alias("ids"))
    return D.pad_batch(b, "batch", {"ids": 0}, 8).select("item_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query("stack_pairs", "SELECT item_id, s AS side, CASE WHEN s = 0 THEN text ELSE 'no ' || text END AS ids FROM benchmark, (SELECT unnest([0, 1]) AS s)")
def stack_pairs(spark, sf):
    return D.stack_pairs(table(spark, sf, "benchmark").select("item_id", F.col("text").alias("a"), F.concat(F.lit("no "), "text").alias("b")), "a", "b", "item_id")


@query("block_causal_mask", """WITH r AS (SELECT doc_id, list_concat(list_transform(range(0, doc_id % 3), lambda x: 1), list_transform(range(0, doc_id % 4), lambda x: 2), list_transform(range(0, doc_id % 2), lambda x: 0)) AS m FROM documents)
SELECT doc_id, array_to_string(list_transform(range(1, len(m) + 1), lambda i: array_to_string(list_transform(range(1, len(m) + 1), lambda j: CASE WHEN m[i] = m[j] AND m[i] > 0 AND j <= i THEN 1 ELSE 0 END), '')), '/') AS rows FROM r""")
def block_causal_mask(spark, sf):
    ones = lambda v, n: F.array_repeat(F.lit(v), (F.col("doc_id") % n).cast("int"))
    d = table(spark, sf, "documents").select("doc_id", F.concat(ones(1, 3), ones(2, 4), ones(0, 2)).alias("m"))
    return d.select("doc_id", F.array_join(F.transform(D.block_mask(F.col("m")), lambda r: F.array_join(r.cast("array<string>"), "")), "/").alias("rows"))
