"""Multi-turn training samples: converters, turn pairs, truncation, label masks, feedback and packed samples.

Token arrays are Columns; ``tokens`` is any Column function from text to an array of ints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.operators.metrics import infer_lengths
from kilnspark.operators.samples import IGNORE, MESSAGE, TEMPLATES, _fill, byte_tokens, pad

Tokens = Callable[[Column], Column]
INTS = "array<int>"
PAIRS = "array<struct<source:array<int>,target:array<int>>>"
WEIGHTED = "array<struct<role:string,content:string,loss_weight:double>>"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _ignored(n: Column) -> Column:
    return F.array_repeat(F.lit(IGNORE), n)


# ---------------------------------------------------------------- converters


def feedback_responses(response: Column, desired: Column) -> Column:
    """A desired answer comes first and an undesired second; the other place is empty."""
    turn = lambda text: F.struct(F.lit("assistant").alias("role"), text.alias("content"))
    empty = F.lit("")
    return F.array(turn(F.when(desired, response).otherwise(empty)), turn(F.when(desired, empty).otherwise(response))).cast(MESSAGE)


def ranking_responses(chosen: Column, rejected: Column) -> Column:
    """Chosen before rejected."""
    turn = lambda text: F.struct(F.lit("assistant").alias("role"), text.alias("content"))
    return F.array(turn(chosen), turn(rejected)).cast(MESSAGE)


def _weighted(role: str, text: Column, weight: float) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"), F.lit(weight).alias("loss_weight"))


def weigh_alpaca(instruction: Column, query: Column, output: Column, system: Column | None = None) -> Column:
    """Messages with loss weights; instruction and input stand together without a break, missing parts are left out."""
    parts = [F.when(output.isNotNull(), _weighted("assistant", output, 1.0))]
    asked = F.concat(F.coalesce(instruction, F.lit("")), F.coalesce(query, F.lit("")))
    parts.insert(0, F.when(instruction.isNotNull() | query.isNotNull(), _weighted("user", asked, 0.0)))
    if system is not None:
        parts.insert(0, F.when(system.isNotNull(), _weighted("system", system, 0.0)))
    return F.filter(F.array(*parts), lambda m: m.isNotNull()).cast(WEIGHTED)


#: Tags of shared conversations and their roles.
SHARED_ROLES = {"system": "system", "human": "user", "gpt": "assistant", "observation": "tool", "function_call": "assistant"}


def weigh_shared(turns: Column) -> Column:
    """Turns of (from, value) as messages with loss weights; unknown tags and calls that are no JSON are left out.

    Answers and calls are trained on.
    """
    role = F.create_map(*[F.lit(x) for pair in SHARED_ROLES.items() for x in pair])
    good = F.filter(turns, lambda t: role[t["from"]].isNotNull() & ((t["from"] != "function_call") | F.try_parse_json(t["value"]).isNotNull()))
    return F.transform(good, lambda t: F.struct(role[t["from"]].alias("role"), t["value"].alias("content"), F.when(t["from"].isin("gpt", "function_call"), 1.0).otherwise(0.0).alias("loss_weight"))).cast(WEIGHTED)


def weigh_messages(messages: Column) -> Column:
    """Messages of (role, content): only the assistant's are trained on."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.when(m["role"] == "assistant", 1.0).otherwise(0.0).alias("loss_weight"))).cast(WEIGHTED)


# ---------------------------------------------------------------- thoughts

THOUGHT = ("<think>\n", "\n</think>\n\n")


def add_thought(text: Column, words: tuple[str, str] = THOUGHT) -> Column:
    """An empty thought before the text."""
    return F.concat(F.lit(words[0] + words[1]), text)


def remove_thought(text: Column, words: tuple[str, str] = THOUGHT) -> Column:
    """Thoughts out, and the line breaks that then lead the text."""
    quoted = ["\\Q" + w + "\\E" for w in words]
    return F.regexp_replace(F.regexp_replace(text, f"(?s){quoted[0]}.*?{quoted[1]}", ""), r"^\n+", "")


def reason_messages(messages: Column, thinking: bool, words: tuple[str, str] = THOUGHT) -> Column:
    """Answers of a reasoning model, one-turn form: old thoughts go; without thinking the last one's goes too; a last answer without any gets an empty thought."""
    bare = lambda m, i: F.struct(m["role"].alias("role"), F.when((i % 2 == 1) & ((i < F.size(messages) - 1) | F.lit(not thinking)), remove_thought(m["content"], words)).otherwise(m["content"]).alias("content"))
    cut = F.transform(messages, bare)
    has = lambda c: F.contains(c, F.lit(words[0].strip())) | F.contains(c, F.lit(words[1].strip()))
    return F.transform(cut, lambda m, i: F.struct(m["role"].alias("role"), F.when((i == F.size(messages) - 1) & ~has(m["content"]), add_thought(m["content"], words)).otherwise(m["content"]).alias("content"))).cast(MESSAGE)


# ---------------------------------------------------------------- encoding


def turn_pairs(messages: Column, system: Column, template: str, tokens: Tokens = byte_tokens) -> Column:
    """(source, target) tokens of each exchange; the template's prefix and the system text lead the first source."""
    t = TEMPLATES[template]
    head = F.concat(F.lit(t.prefix), F.when(F.coalesce(system, F.lit("")) != "", _fill(t.system, system)).otherwise(F.lit("")))
    texts = F.transform(messages, lambda m, i: F.when(i % 2 == 0, F.concat(F.when(i == 0, head).otherwise(F.lit("")), _fill(t.user, m["content"]))).otherwise(_fill(t.assistant, m["content"])))
    ids = F.transform(texts, lambda x: tokens(x))  # tokens may have further parameters
    count = F.floor(F.size(messages) / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.struct(F.get(ids, 2 * k).alias("source"), F.get(ids, 2 * k + 1).alias("target")))
    return F.when(count > 0, pairs).otherwise(_none(PAIRS)).cast(PAIRS)


def encode_turns(pairs: Column, cutoff: int, mask_history: bool = False, train_on_prompt: bool = False, eos: int | None = None) -> Column:
    """Struct of ``input_ids`` and ``labels``: pairs are taken while there is room, each cut to its budget.

    Prompts are ignored in the labels.  With ``mask_history`` the last pairs come
    first, and only the last answer is trained on.  ``eos`` is a token that ends the
    sample and stands in the label where each later prompt begins.
    """
    zero = F.struct(F.lit(0 if eos is None else 1).alias("total"), F.lit(0).alias("turn"), _none(INTS).alias("input_ids"), _none(INTS).alias("labels"))

    def step(acc, pair):
        n, m = (x.cast("int") for x in infer_lengths(F.size(pair["source"]), F.size(pair["target"]), F.lit(cutoff) - acc["total"]))
        source, target = F.slice(pair["source"], F.lit(1), n), F.slice(pair["target"], F.lit(1), m)
        prompt = source if train_on_prompt else _ignored(F.size(source))
        if eos is not None and not train_on_prompt:
            prompt = F.when((acc["turn"] > 0) & (F.size(source) > 0), F.concat(F.array(F.lit(eos)), _ignored(F.size(source) - 1))).otherwise(prompt)
        answer = F.when(acc["turn"] > 0, _ignored(F.size(target))).otherwise(target) if mask_history else target
        ids, labels = F.concat(source, target), F.concat(prompt, answer)
        joined = (F.concat(ids, acc["input_ids"]), F.concat(labels, acc["labels"])) if mask_history else (F.concat(acc["input_ids"], ids), F.concat(acc["labels"], labels))
        taken = F.struct((acc["total"] + F.size(source) + F.size(target)).alias("total"), (acc["turn"] + 1).alias("turn"), joined[0].alias("input_ids"), joined[1].alias("labels"))
        return F.when(acc["total"] >= cutoff, acc).otherwise(taken)

    end = _none(INTS) if eos is None else F.array(F.lit(eos))
    return F.aggregate(F.reverse(pairs) if mask_history else pairs, zero, step, lambda acc: F.struct(F.concat(acc["input_ids"], end).alias("input_ids"), F.concat(acc["labels"], end).alias("labels")))


def _one_turn(pairs: Column) -> tuple[Column, Column]:
    """All but the last answer as prompt, and that answer."""
    before = F.flatten(F.transform(F.slice(pairs, F.lit(1), F.size(pairs) - 1), lambda p: F.concat(p["source"], p["target"])))
    last = F.element_at(pairs, -1)
    return F.concat(before, last["source"]), last["target"]


def encode_unsupervised(pairs: Column, cutoff: int) -> Column:
    """``input_ids`` is the prompt and ``labels`` the answer, each cut to its budget."""
    prompt, answer = _one_turn(pairs)
    n, m = (x.cast("int") for x in infer_lengths(F.size(prompt), F.size(answer), F.lit(cutoff)))
    return F.struct(F.slice(prompt, F.lit(1), n).alias("input_ids"), F.slice(answer, F.lit(1), m).alias("labels"))


def encode_answer(pairs: Column, cutoff: int) -> Column:
    """``input_ids`` of prompt and answer, labels of the answer alone."""
    cut = encode_unsupervised(pairs, cutoff)
    return F.struct(F.concat(cut["input_ids"], cut["labels"]).alias("input_ids"), F.concat(_ignored(F.size(cut["input_ids"])), cut["labels"]).alias("labels"))


def encode_feedback(prompt: Column, responses: Column, kl_responses: Column, system: Column, template: str, cutoff: int, tokens: Tokens = byte_tokens) -> Column:
    """Struct of the sample, its mismatched twin and ``desired``: of two responses the first counts unless it is empty."""
    pick = lambda r: F.when(F.get(r, F.lit(0))["content"] != "", F.get(r, F.lit(0))).otherwise(F.get(r, F.lit(1)))
    sides = [encode_answer(turn_pairs(F.concat(prompt, F.array(pick(r))), system, template, tokens), cutoff) for r in (responses, kl_responses)]
    return F.struct(sides[0]["input_ids"].alias("input_ids"), sides[0]["labels"].alias("labels"), sides[1]["input_ids"].alias("kl_input_ids"), sides[1]["labels"].alias("kl_labels"), (F.get(responses, F.lit(0))["content"] != "").alias("desired"))


def render_weighted(messages: Column, tokens: Tokens = byte_tokens, generate: bool = False) -> Column:
    """ChatML tokens of messages with loss weights: struct of ``input_ids``, ``labels`` and ``loss_weights``."""
    text = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))
    parts = F.transform(messages, lambda m: F.struct(tokens(text(m)).alias("ids"), m["loss_weight"].alias("w")))
    if generate:
        parts = F.concat(parts, F.array(F.struct(tokens(F.lit("<|im_start|>assistant\n")).alias("ids"), F.lit(0.0).alias("w"))))
    joined = lambda f: F.flatten(F.transform(parts, f))
    return F.struct(
        joined(lambda p: p["ids"]).alias("input_ids"), joined(lambda p: F.when(p["w"] > 1e-6, p["ids"]).otherwise(_ignored(F.size(p["ids"])))).alias("labels"),
        joined(lambda p: F.array_repeat(p["w"], F.size(p["ids"]))).alias("loss_weights"),
    )


def render_pair(chosen: Column, rejected: Column, tokens: Tokens = byte_tokens) -> Column:
    """Both sides in one sample; ``token_type_ids`` are 1 for the chosen and 2 for the rejected one."""
    a, b = render_weighted(chosen, tokens), render_weighted(rejected, tokens)
    both = [F.concat(a[c], b[c]).alias(c) for c in ("input_ids", "labels", "loss_weights")]
    kinds = F.concat(F.array_repeat(F.lit(1), F.size(a["input_ids"])), F.array_repeat(F.lit(2), F.size(b["input_ids"])))
    return F.struct(*both, kinds.alias("token_type_ids"))


# ---------------------------------------------------------------- packing and collation


def pack_encoded(samples: DataFrame, bins: DataFrame, key: str, cutoff: int, neat: bool, pad_id: int = 0) -> DataFrame:
    """One row per bin: samples joined in the order of their offsets and padded to ``cutoff`` + 1.

    ``bins`` has (shard, id, bin, offset).  The attention mask numbers the samples from 1
    with ``neat`` and is 1 elsewhere; padding is 0.  Position ids restart at each sample.
    """
    rows = samples.join(bins.withColumnRenamed("id", key), key)
    x = F.sort_array(F.collect_list(F.struct("offset", "input_ids", "labels")))
    joined = rows.groupBy("shard", "bin").agg(x.alias("x"))
    number = lambda r, i: F.array_repeat(i + 1 if neat else F.lit(1), F.size(r["input_ids"]))
    places = lambda r: F.when(F.size(r["input_ids"]) > 0, F.sequence(F.lit(0), F.size(r["input_ids"]) - 1)).otherwise(_none(INTS))
    flat = lambda f: F.flatten(F.transform("x", f))
    return joined.select(
        "shard", "bin", pad(flat(lambda r: r["input_ids"]), cutoff + 1, pad_id).alias("input_ids"), pad(flat(lambda r: r["labels"]), cutoff + 1, IGNORE).alias("labels"),
        pad(flat(number), cutoff + 1, 0).alias("attention_mask"), pad(flat(places), cutoff + 1, 0).alias("position_ids"),
    )


def pad_batch(df: DataFrame, batch: str, columns: dict[str, int], multiple: int = 1) -> DataFrame:
    """Arrays padded to the longest of their batch, rounded up to ``multiple``; ``columns`` maps each to its filler."""
    first = next(iter(columns))
    longest = df.groupBy(batch).agg((F.ceil(F.max(F.size(first)) / multiple) * multiple).cast("int").alias("_longest"))
    out = df.join(longest, batch)
    filled = {c: F.concat(F.col(c), F.array_repeat(F.lit(v), F.col("_longest") - F.size(c))) for c, v in columns.items()}
    return out.withColumns(filled).drop("_longest")


def stack_pairs(df: DataFrame, chosen: str, rejected: str, order: str) -> DataFrame:
    """Chosen rows of a batch before its rejected ones: (order, side, ids)."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col(chosen).alias("ids")), F.struct(F.lit(1).alias("side"), F.col(rejected).alias("ids")))
    return df.select(order, F.explode(sides).alias("x")).select(order, "x.side", "x.ids")


def block_mask(mask: Column) -> Column:
    """Rows of a block-diagonal causal mask: place i sees j <= i of its own sample; padding (0) sees nothing."""
    return F.transform(mask, lambda a, i: F.transform(mask, lambda b, j: ((a == b) & (a > 0) & (j <= i)).cast("int")))
