"""Generators of question rows: option shuffles, alias subsets, hard negatives, templates of a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.operators.numbering import numbered


def shuffle_options(df: DataFrame, key: str, options: str, answer: str, seed: str) -> DataFrame:
    """Options in drawn order with the answer's new letter: columns ``shuffled`` and ``letter``.

    ``answer`` is the index of the right option from 0.
    """
    order = F.transform(options, lambda o, i: F.struct(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"), i.cast("string"))).alias("h"), i.alias("i"), o.alias("o")))
    out = df.withColumn("_o", F.sort_array(order))
    place = F.array_position(F.transform("_o", lambda x: x["i"]), F.col(answer).cast("int"))
    return out.withColumn("shuffled", F.transform("_o", lambda x: x["o"])).withColumn("letter", F.char(place + 64)).drop("_o")


def parse_options(text: Column) -> Column:
    """Bodies of ``X) ...`` option lines; a body runs to the next option."""
    parts = F.split(F.concat(F.lit("\n"), text), r"\n(?=[A-H]\) )")
    return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), lambda p: F.regexp_replace(F.substring(p, F.lit(4), F.length(p)), r"^\s+|\s+$", ""))


def answer_letter(text: Column) -> Column:
    """The letter after a closing ``Therefore,``; A without one."""
    hit = F.regexp_extract(text, r"Therefore, ([A-H])\.?\s*$", 1)
    return F.when(hit != "", hit).otherwise("A")


#: A prime over any number of aliases has no factor in common with their numbers of subsets.
_STEP = 2_147_483_647


def _choose(n: Column, k: int) -> Column:
    """Subsets of ``k`` of ``n`` things, in whole numbers."""
    product, divisor = F.lit(1).cast("long"), 1
    for i in range(k):
        product, divisor = product * (n - i), divisor * (i + 1)
    return F.when(n >= k, F.call_function("div", product, F.lit(divisor).cast("long"))).otherwise(F.lit(0).cast("long"))


def alias_subsets(df: DataFrame, key: str, aliases: str, most: int, cap: int, seed: str) -> DataFrame:
    """``cap`` different drawn subsets of each size up to ``most``, or all if there are fewer, whatever the number of aliases.

    Subsets of a size are numbered in the order of their masks.  Draw i takes number
    (start + i * step) modulo how many there are: the start is hashed, the step shares no
    factor with it, so no number comes twice; a number is turned into its subset from the largest place down.
    """
    rows = df.where(F.size(aliases) > 0).select(key, F.col(aliases).alias("_a"), F.size(aliases).cast("long").alias("_n"))
    sized = rows.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.col("_n"), F.lit(most)).cast("int"))))
    count = F.lit(0).cast("long")
    for k in range(most, 0, -1):
        count = F.when(F.col("size") == k, _choose(F.col("_n"), k)).otherwise(count)
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"), F.col("size").cast("string"))), 1, 13), 16, 10).cast("long")
    drawn = sized.withColumn("_all", count).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_all"), F.lit(cap)) - 1)))
    out = drawn.withColumn("_rest", (start + F.col("_i") * _STEP) % F.col("_all")).withColumn("_at", F.array().cast("array<int>"))
    places = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    for k in range(most, 0, -1):
        here = F.size(_up_to(places, k)) - 1
        out = out.withColumn("_c", F.when(F.col("size") >= k, here))
        out = out.withColumn("_rest", F.when(F.col("size") >= k, F.col("_rest") - _choose(F.col("_c").cast("long"), k)).otherwise(F.col("_rest")))
        out = out.withColumn("_at", F.when(F.col("size") >= k, F.concat("_at", F.array("_c"))).otherwise(F.col("_at")))
    return out.select(key, "size", F.transform(F.sort_array("_at"), lambda i: F.get(F.col("_a"), i)).alias("subset"))


def _up_to(places: Column, k: int) -> Column:
    """The places of which no more subsets of ``k`` lie below than are left."""
    return F.filter(places, lambda x: _choose(x, k) <= F.col("_rest"))


def hard_negatives(owners: DataFrame, alias: str, owner: str, n: int, seed: str) -> DataFrame:
    """For each alias ``n`` foils: the next owners after its own in a drawn order, wrapping round.

    No cross product: each (alias, step) meets one owner by its place.
    """
    groups = owners.select(F.col(owner).alias("foil")).distinct()
    ranked = numbered(groups, [F.md5(F.concat_ws("|", F.lit(seed), F.col("foil").cast("string"))), "foil"])
    total = F.broadcast(groups.agg(F.count("*").alias("total")))
    own = owners.join(ranked.withColumnRenamed("foil", owner), owner).crossJoin(total).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))).where(F.col("step") < F.col("total"))
    return own.withColumn("at", (F.col("at") + F.col("step")) % F.col("total")).join(ranked, "at").select(alias, owner, "foil").distinct()


def phrasings(facts: DataFrame, templates: dict[str, str]) -> DataFrame:
    """Each fact in each phrasing; ``templates`` maps a name to text with {left} and {right}."""
    forms = F.array(*[F.struct(F.lit(k).alias("form"), F.lit(v).alias("pattern")) for k, v in templates.items()])
    rows = facts.withColumn("_f", F.explode(forms))
    text = F.replace(F.replace(F.col("_f.pattern"), F.lit("{left}"), F.col("left")), F.lit("{right}"), F.col("right"))
    return rows.select("left", "right", F.col("_f.form").alias("form"), text.alias("question"))


def schema_templates(properties: DataFrame, edges: DataFrame) -> DataFrame:
    """``(template)``: one test template for each node property and each edge type of a schema."""
    each = properties.select(F.format_string("{x:%s.%s}", "label", "property").alias("template"))
    return each.union(edges.select(F.format_string("{a:%s.%s>b:%s.id}", "src_type", "type", "dst_type")))


def rotate(df: DataFrame, key: str, values: str, times: int) -> DataFrame:
    """Oversample: copy ``k`` of a row has its list rotated by ``k``."""
    out = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    n = F.greatest(F.size(values), F.lit(1))
    k = F.col("copy") % n
    turned = F.concat(F.slice(values, k + 1, n), F.when(k > 0, F.slice(values, F.lit(1), F.greatest(k, F.lit(1)))).otherwise(F.slice(values, F.lit(1), F.lit(0))))
    return out.withColumn(values, turned)


def canonical_items(aliases: DataFrame, group: str, alias: str, prompt: str, seed: str) -> DataFrame:
    """One benchmark item for each group: a drawn alias that is not its own name, the prompt with it, and the prompt's SHA-256.

    ``prompt`` has {alias}; groups without another name have no item.  The least hash is a partial aggregate.
    """
    other = aliases.where(F.lower(F.trim(F.col(alias))) != F.lower(F.trim(F.col(group)))).select(group, F.col(alias).alias("alias"))
    drawn = other.groupBy(group).agg(F.min(F.struct(F.md5(F.concat_ws("|", F.lit(seed), F.col(group), "alias")).alias("h"), "alias")).alias("x")).select(group, F.col("x.alias").alias("alias"))
    text = F.replace(F.lit(prompt), F.lit("{alias}"), F.col("alias"))
    return drawn.select(group, "alias", text.alias("prompt"), F.sha2(text, 256).alias("prompt_hash"))


def valid_variants(rows: DataFrame, key: str, text: str, output: str, least: int, most: int, forbidden: list[str]) -> DataFrame:
    """Generated variants that keep the rules: length of the text, no forbidden word in it, an output, and each text once (the least key stays)."""
    n = F.length(text)
    good = rows.where((n >= least) & (n <= most) & (F.trim(F.coalesce(output, F.lit(""))) != ""))
    for word in forbidden:
        good = good.where(~F.contains(F.lower(text), F.lit(word.lower())))
    first = good.groupBy(F.sha1(text).alias("_h")).agg(F.min(key).alias(key))
    return good.join(first.select(key), key, "left_semi")
