"""Training rows out of a catalogue of named actors with synonyms: checks of what comes in, three kinds of rows, checks of what goes out.

A catalogue is one row with ``type`` and ``values``, an array of (value, uuid, meta(synonyms, country)).
Subsets, phrasings and foils are drawn by hashes, so rows are the same on any cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnspark.operators.generate import alias_subsets, hard_negatives

VALUES = "array<struct<value:string,uuid:string,meta:struct<synonyms:array<string>,country:string>>>"
#: What a synonym must have and must not hold.
LEAST_CHARS = 3
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
SUBSET_ROW, CARD_ROW, REJECTION_ROW = "CANON.1", "CANON.2", "CANON.3"

#: Phrasings; {aliases}, {name}, {alias} and {foil} are filled in.
ASK_NAME = ("Which actor is known by these names: {aliases}?", "Vendors write about {aliases}. Give the catalogue's name for that actor.", "Resolve [{aliases}] to one catalogued actor.")
ASK_CARD = ("Write the alias card of {name}.", "List name, country and synonyms of {name}.", "Give the catalogue's record of {name}.")
ASK_CLAIM = ('Does the alias "{alias}" belong to {foil}?', 'Confirm or reject: "{alias}" is {foil}.')


def cluster_faults(bundle: DataFrame, expected: str) -> DataFrame:
    """``(at, fault)`` of a catalogue, ``at`` being the place of a value or -1; no rows for a sound one."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    whole = F.filter(F.array(F.when(F.coalesce(F.col("type"), F.lit("")) != expected, "type"), F.when(F.coalesce(F.size("values"), F.lit(0)) < 1, "values")), lambda x: x.isNotNull())
    top = bundle.select(F.lit(-1).alias("at"), F.explode(whole).alias("fault"))
    each = bundle.select(F.posexplode("values").alias("at", "v"))
    marks = F.array(F.when(blank(F.col("v.value")), "value"), F.when(blank(F.col("v.uuid")), "uuid"), F.when(F.exists("v.meta.synonyms", lambda s: s.isNull()), "synonyms"))
    return top.unionByName(each.select("at", F.explode(F.filter(marks, lambda x: x.isNotNull())).alias("fault")))


def clean_synonyms(name: Column, synonyms: Column) -> Column:
    """Synonyms trimmed, in order, each once whatever its case: long enough, without control characters, other than the name."""
    trimmed = F.filter(F.transform(synonyms, lambda s: F.trim(s)), lambda s: s.isNotNull() & (F.length(s) >= LEAST_CHARS) & ~s.rlike(CONTROL) & (F.lower(s) != F.lower(F.trim(name))))
    none = F.array().cast("array<string>")
    first = F.aggregate(trimmed, none, lambda kept, s: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(s)), kept).otherwise(F.concat(kept, F.array(s))))
    return F.coalesce(first, none)


def actors(bundle: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """``(uuid, name, synonyms, country)``; a country without a name in ``countries`` keeps its code, none is empty."""
    rows = bundle.select(F.explode("values").alias("v"))
    code = F.upper(F.trim(F.coalesce(F.col("v.meta.country"), F.lit(""))))
    named = _looked_up(code, countries or {})
    return rows.select(F.col("v.uuid").alias("uuid"), F.trim("v.value").alias("name"), clean_synonyms(F.col("v.value"), F.col("v.meta.synonyms")).alias("synonyms"), named.alias("country"))


def _looked_up(code: Column, names: dict[str, str]) -> Column:
    out = code
    for k, v in names.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def _pick(choices: tuple[str, ...], seed: str, *key: Column) -> Column:
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *key)), 1, 8), 16, 10).cast("long") % len(choices)
    return F.get(F.array(*[F.lit(c) for c in choices]), place.cast("int"))


def subset_rows(known: DataFrame, seed: str, most: int = 5, cap: int = 12, ask: tuple[str, ...] = ASK_NAME) -> DataFrame:
    """``(uuid, input, output, shortname)``: up to ``cap`` drawn subsets of each size of an actor's synonyms, and the name they stand for."""
    drawn = alias_subsets(known, "uuid", "synonyms", most, cap, seed).join(known.select("uuid", "name", "country"), "uuid")
    listed = F.array_join("subset", ", ")
    text = F.replace(_pick(ask, seed, F.col("uuid"), listed), F.lit("{aliases}"), listed)
    where = F.when(F.col("country") != "", F.concat(F.lit(" ("), "country", F.lit(")"))).otherwise("")
    return drawn.select("uuid", text.alias("input"), F.concat(F.lit("Therefore, the actor is "), "name", where, F.lit(".")).alias("output"), F.lit(SUBSET_ROW).alias("shortname"))


def card_rows(known: DataFrame, seed: str, ask: tuple[str, ...] = ASK_CARD) -> DataFrame:
    """One card with all synonyms for each actor that has some."""
    text = F.replace(_pick(ask, seed, F.col("uuid")), F.lit("{name}"), F.col("name"))
    card = F.concat(F.lit("Name: "), "name", F.lit(". Country: "), F.when(F.col("country") != "", F.col("country")).otherwise("not documented"), F.lit(". Synonyms: "), F.array_join("synonyms", ", "), F.lit("."))
    return known.where(F.size("synonyms") > 0).select("uuid", text.alias("input"), card.alias("output"), F.lit(CARD_ROW).alias("shortname"))


def rejection_rows(known: DataFrame, seed: str, foils: int = 5, ask: tuple[str, ...] = ASK_CLAIM) -> DataFrame:
    """Claims to reject: an alias that one actor alone has, against drawn other actors."""
    each = known.select("uuid", F.explode("synonyms").alias("alias")).withColumn("low", F.lower("alias"))
    single = each.groupBy("low").agg(F.count_distinct("uuid").alias("owners"), F.min("uuid").alias("uuid"), F.min("alias").alias("alias")).where("owners = 1").select("uuid", "alias")
    # actors without an alias of their own can be foils as well
    all_ = known.where("name <> ''").select("uuid", F.lit(None).cast("string").alias("alias")).unionByName(single)
    claims = hard_negatives(all_, "alias", "uuid", foils, seed).where(F.col("alias").isNotNull())
    named = claims.join(known.select("uuid", "name"), "uuid").join(known.select(F.col("uuid").alias("foil"), F.col("name").alias("foil_name")), "foil").where(F.col("foil_name") != "")
    text = F.replace(F.replace(_pick(ask, seed, F.col("alias"), F.col("foil")), F.lit("{alias}"), F.col("alias")), F.lit("{foil}"), F.col("foil_name"))
    answer = F.concat(F.lit('Reject. "'), "alias", F.lit('" is no name of '), "foil_name", F.lit("; it belongs to "), "name", F.lit("."))
    return named.select("uuid", text.alias("input"), answer.alias("output"), F.lit(REJECTION_ROW).alias("shortname"))


def row_faults(rows: DataFrame, key: str, pattern: str) -> DataFrame:
    """``(key, fault)``: blank columns, short names that don't fit ``pattern``, inputs with outputs that came before by ``key``."""
    marks = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in ("input", "output", "shortname")]
    marks.append(F.when(~F.coalesce(F.col("shortname").rlike(pattern), F.lit(False)), "pattern"))
    first = F.min(key).over(Window.partitionBy(F.md5(F.concat(F.length("input").cast("string"), F.lit("|"), "input", "output"))))
    marked = rows.withColumn("_first", first).withColumn("_marks", F.filter(F.array(*marks, F.when(F.col("_first") < F.col(key), "again")), lambda x: x.isNotNull()))
    return marked.select(key, F.explode("_marks").alias("fault"))
