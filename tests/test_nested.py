"""Nested text against plain Python, tool dialects there and back."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kilnspark.functions import nested as N
from kilnspark.operators import tools as T


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def got(df, column):
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def first_object(text):
    at = text.find("{")
    if at < 0:
        return None
    depth, quoted, i = 0, False, at
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 2
            continue
        if c == '"':
            quoted = not quoted
        elif not quoted and c in "{}":
            depth += 1 if c == "{" else -1
            if depth == 0:
                return text[at : i + 1]
        i += 1
    return None


def test_balanced_objects(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice('{}{}"\\a \n') for _ in range(rng.randrange(14))) for _ in range(1500)]
    values += ['x{"a": {"b": "}"}} {"c": 1}', '{"a": "\\"}"}', "{", "}{", "", '{"é": "{"}x', "{" * 300 + "}" * 300]
    assert got(texts(spark, values), N.balanced(F.col("t"))) == [first_object(v) for v in values]


def test_splits_outside_brackets_and_quotes(spark):
    cases = {"a, b": ["a", " b"], "f(x, y), [1, [2, 3]], {'k': ','}": ["f(x, y)", " [1, [2, 3]]", " {'k': ','}"], 'x="a, \\" (b", y=2': ['x="a, \\" (b"', " y=2"], "": [], " ": [], "one": ["one"], ",": ["", ""], "it's, open": ["it's", " open"]}
    assert got(texts(spark, list(cases)), N.split_top(F.col("t"))) == list(cases.values())


def test_json_is_respaced_in_order(spark):
    values = ['{"b":1,"a":[1,2,{"c":"x,y: z"}]}', '{ "k" :\n"q\\"uo,te" , "n":null}', "[]", '{"e":"é：,"}']
    assert got(texts(spark, values), N.spaced_json(F.col("t"))) == [json.dumps(json.loads(v), ensure_ascii=False) for v in values]
    pairs = got(texts(spark, values[:2]), N.json_pairs(F.col("t")))
    assert [[(p.key, json.loads(p.value)) for p in row] for row in pairs] == [list(json.loads(v).items()) for v in values[:2]]


ARGUMENTS = [
    {},
    {"q": "plain words", "n": 3, "deep": {"a": [1, {"b": "c, d"}], "e": None}, "flag": True},
    {"list": ["x, y", "(z)", [1.5, -2]], "s": "with = and ] and )"},
    {"text": "two\nlines"},
]


def wrapped(text, dialect):
    return F.concat(F.lit("<minimax:tool_call>\n"), text, F.lit("\n</minimax:tool_call>")) if dialect == "minimax2" else text


@pytest.mark.parametrize("dialect", sorted(T.DIALECTS))
def test_nested_arguments_there_and_back(spark, dialect):
    rows = [[("look_up", json.dumps(a, ensure_ascii=False)), ("stop", '{"now": true}')] for a in ARGUMENTS]
    if dialect == "glm4":
        rows = [r[:1] for r in rows]
    if dialect == "lfm2":
        rows = rows[:3]  # a string in quotes holds no bare line break
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, calls {T.CALLS}")
    found = got(df, T.extract_calls(wrapped(T.call_text(F.col("calls"), dialect), dialect), dialect))
    assert [[(c.name, json.loads(c.arguments)) for c in row] for row in found] == [[(n, json.loads(a)) for n, a in row] for row in rows]


def test_forms_of_nested_values(spark):
    calls = [("f", '{"x":{"b":1,"a":[1,2]},"s":"t"}')]
    df = spark.createDataFrame([(0, calls)], f"i int, calls {T.CALLS}")
    text = {d: got(df, T.call_text(F.col("calls"), d))[0] for d in T.DIALECTS}
    assert text["seed"] == '\n<seed:tool_call>\n<function=f\n<parameter=x>{"b": 1, "a": [1, 2]}</parameter>\n<parameter=s>t</parameter>\n</function>\n</seed:tool_call>'
    assert text["lfm2"] == '<|tool_call_start|>[f(x={"b": 1, "a": [1, 2]}, s="t")]<|tool_call_end|>'
    assert text["qwen"] == '<tool_call>\n{"name": "f", "arguments": {"x": {"b": 1, "a": [1, 2]}, "s": "t"}}\n</tool_call>'
    assert text["default"] == 'Action: f\nAction Input: {"x":{"b":1,"a":[1,2]},"s":"t"}'
    assert text["minimax2"] == '<invoke name="f">\n<parameter name="x">{"b": 1, "a": [1, 2]}</parameter>\n<parameter name="s">t</parameter>\n</invoke>'


def test_written_literals_and_plain_text(spark):
    mark = lambda x: f"<|tool_call_start|>{x}<|tool_call_end|>"
    cases = {
        mark("[f(a='it\\'s', b=[1, 'x'], c=None, d={'k': True})]"): [("f", {"a": "it's", "b": [1, "x"], "c": None, "d": {"k": True}})],
        mark("f(a=1)"): [("f", {"a": 1})],
        mark("[f(a=name)]"): None,
        mark("[f(1)]"): None,
        mark("words"): None,
        "f(a=1)": None,
        mark("[f(a=true), g()]"): [("f", {"a": True}), ("g", {})],
    }
    found = got(texts(spark, list(cases)), T.extract_calls(F.col("t"), "lfm2"))
    assert [None if row is None else [(c.name, json.loads(c.arguments)) for c in row] for row in found] == list(cases.values())
    bare = '<invoke name="f">\n<parameter name="a">1</parameter>\n</invoke>'
    assert got(texts(spark, [bare, f"<minimax:tool_call>{bare}</minimax:tool_call>"]), T.extract_calls(F.col("t"), "minimax2"))[0] is None
    jsonish = '<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call>'
    assert got(texts(spark, [jsonish]), T.extract_calls(F.col("t"), "glm4_moe"))[0][0].name == "f"
    assert got(texts(spark, [jsonish, "nothing"]), T.any_dialect(F.col("t"))) == ["glm4_moe", None]


TOOLS = [
    {"type": "function", "function": {"name": "look_up", "description": "Find {name}", "parameters": {"type": "object", "properties": {"q": {"type": "string", "description": "what"}, "n": {"type": "array", "items": {"type": "integer"}, "enum": ["1", "2"]}}, "required": ["q"]}}},
    {"name": "stop", "parameters": {"type": "object", "properties": {}}},
]


@pytest.mark.parametrize("dialect", sorted(T.TOOL_PROMPTS))
def test_descriptions(spark, dialect):
    text = json.dumps(TOOLS)
    found = got(texts(spark, [text, "", None, "[]", "no list"]), T.tools_text(F.col("t"), dialect, "01 Jan 2030"))
    assert found[1:] == ["", "", "", None]
    function, bare = TOOLS[0]["function"], TOOLS[1]
    typed = {"type": "function", "function": bare}
    show = lambda *x: [json.dumps(v, ensure_ascii=False) for v in x]
    for part in {
        "default": ["> Tool Name: look_up\nTool Description: Find {name}\nTool Args:\n  - q (string, required): what\n  - n (array): , should be one of [1, 2], where each item should be integer\n\n", "(one of [look_up, stop])", '{"input": "hello world", "num_beams": 5}'],
        "glm4": ["\n\n## look_up\n\n" + json.dumps(function, indent=4), "\n\n## stop"],
        "llama3": ["Today Date: 01 Jan 2030", json.dumps(TOOLS[0], indent=4) + "\n\n", json.dumps(typed, indent=4)],
        "seed": ["tools.\n" + show(TOOLS)[0] + "\n工具"],
        "mistral": ["[AVAILABLE_TOOLS] " + show([TOOLS[0], typed])[0] + "[/AVAILABLE_TOOLS]"],
        "lfm2": [show([function, bare])[0]],
        "minimax1": ["\n".join(show(function, bare)) + "\n</tools>"],
        "minimax2": [f"<tool>{show(bare)[0]}</tool>\n</tools>"],
        "qwen35": ["<tools>\n" + "\n".join(show(function, bare)) + "\n</tools>", "</IMPORTANT>"],
    }.get(dialect, ["<tools>\n" + "\n".join(show(TOOLS[0], typed)) + "\n</tools>"]):
        assert part in found[0]


def test_one_json_value_and_nothing_else(spark):
    values = ['{"a": 1}', ' [1, 2]\n', "1", "null", '"x"', '{"a": 1}{"b": 2}', '{"a": 1}, {"b": 2}', "1,null", "1,2", "", " ", "words", '{"a": ', None, "[1] x", "]["]
    assert got(texts(spark, values), N.is_json(F.col("t"))) == [True] * 5 + [False] * 11


def first_path(value, key, path=()):
    inner = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for name, x in inner:
        if isinstance(value, dict) and name == key:
            return "/".join(map(str, (*path, name)))
        if (deeper := first_path(x, key, (*path, name))) is not None:
            return deeper
    return None


def test_first_place_of_a_key(spark):
    rng = random.Random(4)

    def some(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice([1, "k", None, True, "a:b", "{", 2.5])
        if rng.random() < 0.5:
            return [some(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["k", "a", "b,", "é", '"', "k2", "x:"]): some(depth - 1) for _ in range(rng.randrange(4))}

    values = [some(4) for _ in range(400)]
    dumps = [json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for v in values] + ["{broken", None, '{"a": 1}{"k": 1}', ""]
    assert got(texts(spark, dumps), N.find_key(F.col("t"), "k")) == [first_path(v, "k") for v in values] + [None] * 4


def test_strings_of_json_are_changed_and_keys_stay(spark):
    values = ['{"ab": "ab", "l": ["ab", {"ab": 1}], "n": 5}', '"ab"', "[]"]
    assert got(texts(spark, values), N.map_strings(F.col("t"), lambda v: F.replace(v, F.lit("b"), F.lit('"')))) == ['{"ab": "a\\"", "l": ["a\\"", {"ab": 1}], "n": 5}', '"a\\""', "[]"]


def test_long_strings_do_not_recurse(spark):
    long = "word \\\\ and \\n" * 30_000
    values = ['{"a": "%s", "k": {"b": "%s"}}' % (long, long), '"%s' % long, "'%s" % long]
    df = texts(spark, values)
    assert got(df, N.find_key(F.col("t"), "b")) == ["k/b", None, None]
    assert got(df, F.length(N.balanced(F.col("t")))) == [len(values[0]), None, None]
    assert got(df, F.size(N.json_pairs(F.col("t"))))[0] == 2 and got(df, F.size(N.split_top(F.col("t")))) == [1, 1, 1]
    assert json.loads(got(df, N.map_strings(F.col("t"), F.upper))[0])["k"]["b"] == json.loads('"%s"' % long).upper()
