"""Nested text as Column expressions: balanced objects, splits outside brackets and quotes, JSON respaced.

All fold over runs, not characters: a run is a quoted string, a bracket, a
separator or what stands between them.  Text without brackets is one run.  Loops
of patterns are possessive, so that they don't recurse on long strings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Quoted strings (double, single), one sign of structure, or anything else; an open quote is a run of its own.
_RUNS = r"""(?s)"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+'|[\[\](){}:,="']|[^\[\](){}:,="']+"""
#: The same for JSON, where single quotes are text.
_JSON_RUNS = r"""(?s)"(?:[^"\\]++|\\.)*+"|[\[\]{}:,"]|[^\[\]{}:,"\s]+"""


def bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often ``use`` names it, also within functions of its elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bare(text: Column) -> Column:
    """The text without white space at its ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def runs(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def balanced(text: Column) -> Column:
    """From the first ``{`` to the brace that closes it; braces in quotes don't count, a backslash hides the sign after it.  Null if it never closes."""
    at = F.instr(text, "{")
    rest = F.when(at > 0, text.substr(at, F.length(text)))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("used"), F.lit(0).alias("end"))

    def step(s: Column, run: Column) -> Column:
        used = s["used"] + F.length(run)
        depth = s["depth"] + F.when(s["quoted"], 0).when(run == "{", 1).when(run == "}", -1).otherwise(0)
        closed = (depth == 0) & (run == "}") & ~s["quoted"]
        now = F.struct(depth.alias("depth"), F.when(run == '"', ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"), used.alias("used"), F.when(closed, used).otherwise(0).alias("end"))
        return F.when(s["end"] > 0, s).otherwise(now)

    end = F.aggregate(runs(rest, r"""(?s)\\.?|["{}]|[^\\"{}]+"""), start, step)["end"]
    return F.when(end > 0, rest.substr(F.lit(1), end))


def split_top(text: Column, separator: str = ",", pattern: str = _RUNS) -> Column:
    """Parts of ``text`` between separators that stand outside all brackets and quotes; none for blank text."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("part"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, run: Column) -> Column:
        cut = (run == separator) & (s["depth"] == 0)
        depth = s["depth"] + F.when(run.isin("[", "(", "{"), 1).when(run.isin("]", ")", "}"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(cut, "").otherwise(F.concat(s["part"], run)).alias("part"), F.when(cut, F.concat(s["parts"], F.array(s["part"]))).otherwise(s["parts"]).alias("parts"))

    # the last part joins the others at the end of the fold, so that it runs once
    blank = lambda s: (F.size(s["parts"]) == 0) & (F.trim(s["part"]) == "")
    return F.aggregate(runs(text, pattern), start, step, lambda s: F.when(blank(s), s["parts"]).otherwise(F.concat(s["parts"], F.array(s["part"]))))


def spaced_json(text: Column) -> Column:
    """JSON with one space after commas and colons and none elsewhere; keys keep their order."""
    return F.array_join(F.transform(runs(text, _JSON_RUNS), lambda r: F.when(r.isin(",", ":"), F.concat(r, F.lit(" "))).otherwise(r)), "")


def json_pairs(text: Column) -> Column:
    """``array<struct<key,value>>`` of a JSON object, in order; values stay JSON text."""
    inner = F.regexp_extract(text, r"(?s)^\s*\{(.*)\}\s*$", 1)
    entry = r'(?s)^\s*("(?:[^"\\]++|\\.)*+")\s*:(.*+)'
    return F.transform(split_top(inner, ",", r"""(?s)"(?:[^"\\]++|\\.)*+"|[\[\]{},"]|[^\[\]{},"]+"""), lambda p: F.struct(json_text(F.regexp_extract(p, entry, 1)).alias("key"), bare(F.regexp_extract(p, entry, 2)).alias("value")))


def is_json(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else; the engine's own parser stops after the first.

    What doesn't begin like a value is not parsed: a parser that fails costs more than one that succeeds.
    """
    at = lambda v, k: F.try_variant_get(v, f"$[{k}]", "variant")
    begins = lambda listed: listed.rlike(r'^\[[ \t\n\r]*["\[{0-9tfn-]')
    one = lambda listed: begins(listed) & bound(F.try_parse_json(listed), lambda v: at(v, 0).isNotNull() & at(v, 1).isNull())
    return F.coalesce(bound(F.concat(F.lit("["), text, F.lit("]")), one), F.lit(False))


def json_text(text: Column) -> Column:
    """The string that a JSON string stands for."""
    return F.try_parse_json(text).cast("string")


def json_string(text: Column) -> Column:
    """A string as JSON; letters beyond ASCII stay as they are."""
    return bound(F.to_json(F.array(text)), lambda listed: listed.substr(F.lit(2), F.length(listed) - 2))


def literal_json(text: Column) -> Column:
    """A literal of numbers, strings, lists and dictionaries, in single or double quotes, as JSON text."""

    def one(run: Column) -> Column:
        inner = F.replace(run.substr(F.lit(2), F.length(run) - 2), F.lit("\\'"), F.lit("'"))
        single = F.concat(F.lit('"'), F.replace(inner, F.lit('"'), F.lit('\\"')), F.lit('"'))
        word = F.trim(run)
        return F.when(run.rlike("^'.*'$"), single).when(word == "True", "true").when(word == "False", "false").when(word == "None", "null").otherwise(run)

    return spaced_json(F.array_join(F.transform(runs(text, _RUNS), one), ""))


def form_pattern(form: str, loose: bool = True, **groups: str) -> str:
    """The pattern that reads what ``form`` prints: marks become groups, white space is free."""
    out, rest = "", form
    while True:
        at = {k: rest.find("{" + k + "}") for k in groups if "{" + k + "}" in rest}
        mark = min(at, key=at.__getitem__, default=None)
        literal, rest = (rest, "") if mark is None else (rest[: at[mark]], rest[at[mark] + len(mark) + 2 :])
        out += "".join(r"\s*" if loose and x.isspace() else re.escape(x) for x in re.split(r"(\s+)", literal) if x)
        if mark is None:
            return out
        out += groups[mark]


def json_items(text: Column) -> Column:
    """Elements of a JSON list, as JSON text."""
    inner = F.regexp_extract(text, r"(?s)^\s*\[(.*)\]\s*$", 1)
    return F.transform(split_top(inner, ",", r"""(?s)"(?:[^"\\]++|\\.)*+"|[\[\]{},"]|[^\[\]{},"]+"""), lambda x: F.trim(x))


def json_object(pairs: Column) -> Column:
    """JSON text of ``array<struct<key,value>>``, values being JSON text."""
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(json_string(p["key"]), F.lit(": "), p["value"])), ", "), F.lit("}"))


#: A key with its colon, a string, a sign of structure, or anything else.
_KEYED_RUNS = r"""(?s)"(?:[^"\\]++|\\.)*+"\s*:|"(?:[^"\\]++|\\.)*+"|[\[\]{},"]|[^\[\]{},:"\s]+"""


def map_strings(text: Column, change) -> Column:
    """JSON whose string values are changed, keys being left alone; respaced."""

    def one(run: Column) -> Column:
        key = F.concat(F.regexp_replace(run, r"\s*:$", ""), F.lit(": "))
        return F.when(run == ",", ", ").when(run.startswith('"') & run.endswith(":"), key).when(run.startswith('"'), json_string(change(json_text(run)))).otherwise(run)

    return F.array_join(F.transform(runs(text, _KEYED_RUNS), one), "")


def find_key(text: Column, key: str) -> Column:
    """Path to the first place of a key in a JSON text, depth first, places of lists from 0; null without one or where the text is no JSON.

    One fold over the runs of the text keeps the path that it is on; depth first is the order of the text.
    """
    names = lambda: F.array().cast("array<string>")
    start = F.struct(names().alias("path"), names().alias("kinds"), F.lit(False).alias("key"), F.lit(None).cast("string").alias("found"))

    def step(s: Column, run: Column) -> Column:
        n = F.size(s["kinds"])
        top = F.get(s["kinds"], n - 1)
        less = F.slice(s["path"], F.lit(1), F.greatest(n - 1, F.lit(0)))
        named = s["key"] & run.startswith('"')
        here = F.concat(less, F.array(json_text(run)))
        opened, closed = run.isin("{", "["), run.isin("}", "]")
        path = F.when(opened, F.concat(s["path"], F.array(F.when(run == "[", "0").otherwise("")))).when(closed, less).when(named, here)
        path = path.when((run == ",") & (top == "["), F.concat(less, F.array((F.get(s["path"], n - 1).cast("int") + 1).cast("string")))).otherwise(s["path"])
        kinds = F.when(opened, F.concat(s["kinds"], F.array(run))).when(closed, F.slice(s["kinds"], F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(s["kinds"])
        expects = (run == "{") | ((run == ",") & F.coalesce(top == "{", F.lit(False)))
        hit = F.when(named & (json_text(run) == key), F.array_join(here, "/"))
        return F.struct(path.alias("path"), kinds.alias("kinds"), expects.alias("key"), F.coalesce(s["found"], hit).alias("found"))

    return F.when(is_json(text), F.aggregate(runs(text, _JSON_RUNS), start, step)["found"])
