"""Benchmark tasks out of records: a drawn pool, a prompt with its parts filled in, and the answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.operators.balance import draw
from kilnspark.operators.numbering import numbered


def filled(prompt: str, *parts: Column) -> Column:
    """``prompt`` with its ``{}`` marks filled in order; braces in parts stay as they are, ``{{`` and ``}}`` are single braces."""
    marked = prompt.replace("{{", "\x00").replace("}}", "\x01").split("{}")
    if len(marked) != len(parts) + 1:
        raise ValueError(f"{len(marked) - 1} marks for {len(parts)} parts")
    text = [m.replace("\x00", "{").replace("\x01", "}") for m in marked]
    out = [F.lit(text[0])]
    for part, rest in zip(parts, text[1:], strict=True):
        out += [F.coalesce(part.cast("string"), F.lit("")), F.lit(rest)]
    return F.concat(*out)


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def pool(records: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` drawn records; 0 or less keeps all."""
    return records if n <= 0 else records.orderBy(draw(seed, key), key).limit(n)


def weakness_tasks(records: DataFrame, prompt: str, n: int = 0, seed: str = "tasks") -> DataFrame:
    """Records (cve_id, description, weaknesses) with one weakness: find its id."""
    one = F.array_distinct(F.filter("weaknesses", lambda w: w.rlike(r"^CWE-\d+$")))
    rows = records.withColumn("_one", one).where(F.size("_one") == 1)
    text = one_line(F.col("description"))
    return pool(rows, "cve_id", n, seed).select("cve_id", text.alias("description"), filled(prompt, text).alias("prompt"), F.get("_one", F.lit(0)).alias("answer"))


def severity_tasks(records: DataFrame, prompt: str, n: int = 0, seed: str = "tasks") -> DataFrame:
    """Records (cve_id, description, score, severity, vector) that have a vector: find it."""
    text = one_line(F.col("description"))
    rows = records.where(F.coalesce("vector", F.lit("")) != "")
    return pool(rows, "cve_id", n, seed).select("cve_id", text.alias("description"), filled(prompt, text).alias("prompt"), F.col("vector").alias("answer"), F.col("score").alias("vector_score"), "severity")


def mitigation_tasks(records: DataFrame, prompt: str, n: int = 0, seed: str = "tasks") -> DataFrame:
    """Records (technique_id, description, platform, mitigations, scenario): name as many mitigations as there are."""
    asked = filled(prompt, F.coalesce("platform", F.lit("Enterprise")), F.size("mitigations"), F.coalesce("scenario", F.lit("")))
    return pool(records, "technique_id", n, seed).select("technique_id", "description", "scenario", asked.alias("prompt"), F.array_join("mitigations", ", ").alias("answer"))


def technique_tasks(records: DataFrame, prompt: str, n: int = 0, seed: str = "tasks") -> DataFrame:
    """Records (technique_id, description, platform, scenario): find the technique."""
    asked = filled(prompt, F.coalesce("platform", F.lit("Enterprise")), F.coalesce("scenario", F.lit("")))
    return pool(records, "technique_id", n, seed).select("technique_id", "description", "scenario", asked.alias("prompt"), F.col("technique_id").alias("answer"))


def actor_tasks(records: DataFrame, prompt: str, n: int = 0) -> DataFrame:
    """Records (url, actions, description, actor): who did it; the first ``n`` by url.  Anonymised actions go before descriptions, records without text are left out."""
    text = one_line(F.when(F.coalesce("actions", F.lit("")) != "", F.col("actions")).otherwise(F.col("description")))
    rows = records.withColumn("_t", text).where(F.col("_t") != "")
    rows = rows if n <= 0 else rows.orderBy("url").limit(n)
    return rows.select("url", F.col("_t").alias("description"), filled(prompt, F.col("_t")).alias("prompt"), F.coalesce("actor", F.lit("")).alias("answer"))


def choice_tasks(records: DataFrame, prompt: str) -> DataFrame:
    """Records (id, question, option_a to option_e, prompt, correct_answer): a missing prompt is built if all parts are there, a missing answer read from its first letter."""
    options = [F.trim(F.regexp_replace(F.coalesce(f"option_{c}", F.lit("")), r"^[A-E][\).]\s*", "")) for c in "abcde"]
    block = F.concat(F.lit("Question: "), F.col("question"), *[x for c, o in zip("ABCDE", options, strict=True) for x in (F.lit(f"\n{c}) "), o)])
    whole = F.lit(True)
    for c in ("question", *[f"option_{c}" for c in "abcde"]):
        whole = whole & (F.coalesce(c, F.lit("")) != "")
    letter = F.substring(F.upper(F.trim("correct_answer")), 1, 1)
    built = (F.coalesce("prompt", F.lit("")) == "") & whole
    answer = F.when(built & (F.coalesce("answer", F.lit("")) == "") & letter.isin(*"ABCDE"), letter).otherwise(F.col("answer"))
    return records.withColumn("_answer", answer).withColumn("prompt", F.when(built, filled(prompt, block)).otherwise(F.col("prompt"))).withColumn("answer", F.col("_answer")).drop("_answer")


#: Tasks by name.
BUILDERS: dict[str, Callable[..., DataFrame]] = {"rcm": weakness_tasks, "vsp": severity_tasks, "rms": mitigation_tasks, "ate": technique_tasks, "taa": actor_tasks, "mcq": choice_tasks}


def fact_questions(facts: DataFrame, forward: dict[str, str], backward: dict[str, str], seed: str, options: int = 5) -> DataFrame:
    """``(left, right, form, question, options, letter)``: each fact in each phrasing, both ways, with drawn foils.

    ``forward`` phrasings have {left} and ask for the right side, ``backward`` the other way.  Foils are the
    next values of that side in a drawn order, after the answer's own; options come in a drawn order of the question.
    """
    parts = []
    for side, other, forms in (("right", "left", forward), ("left", "right", backward)):
        values = facts.select(F.col(side).alias("_v")).distinct()
        ranked = numbered(values, [F.md5(F.concat_ws("|", F.lit(seed), "_v")), "_v"], "_at")
        total = F.broadcast(values.agg(F.count("*").alias("_n")))
        own = facts.join(ranked.withColumnRenamed("_v", side), side).crossJoin(total)
        near = own.withColumn("_step", F.explode(F.sequence(F.lit(0), F.least(F.lit(options), F.col("_n").cast("int")) - 1)))
        near = near.withColumn("_at", (F.col("_at") + F.col("_step")) % F.col("_n")).join(ranked, "_at")
        each = near.withColumn("_f", F.explode(F.array(*[F.struct(F.lit(k).alias("form"), F.lit(v).alias("text")) for k, v in forms.items()])))
        order = F.md5(F.concat_ws("|", F.lit(seed), "left", "right", "_f.form", "_v"))
        grouped = each.groupBy("left", "right", F.col("_f.form").alias("form"), F.col("_f.text").alias("text")).agg(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("h"), "_v"))), lambda x: x["_v"]).alias("options"))
        letter = F.char(64 + F.array_position("options", F.col(side)))
        parts.append(grouped.select("left", "right", "form", F.replace("text", F.lit("{" + other + "}"), F.col(other)).alias("question"), "options", letter.alias("letter")))
    return parts[0].unionByName(parts[1])
