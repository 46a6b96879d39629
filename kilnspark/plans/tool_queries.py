"""Queries of tool dialects over the conversations table: text of calls, and calls out of text."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.operators import tools as T
from kilnspark.registry import query, table

_TEXT = "trim(regexp_replace(text, '[^A-Za-z ]+', '', 'g'))"


def _calls(spark, sf, several: bool):
    c = table(spark, sf, "conversations").where("text is not null")
    said = F.trim(F.regexp_replace("text", "[^A-Za-z ]+", ""))
    one = F.struct(F.concat(F.lit("say_"), "role").alias("name"), F.concat(F.lit('{"what": "'), said, F.lit('", "times": '), F.col("turn").cast("string"), F.lit("}")).alias("arguments"))
    two = F.struct(F.lit("stop").alias("name"), F.lit('{"now": true}').alias("arguments"))
    return c.select("conv_id", "turn", (F.array(one, two) if several else F.array(one)).alias("calls"))


_FORMS = {
    "default": "'Action: say_' || role || chr(10) || 'Action Input: ' || a || chr(10) || 'Action: stop' || chr(10) || 'Action Input: {\"now\": true}'",
    "llama3": "'[{\"name\": \"say_' || role || '\", \"parameters\": ' || a || '}, {\"name\": \"stop\", \"parameters\": {\"now\": true}}]'",
    "mistral": "'[{\"name\": \"say_' || role || '\", \"arguments\": ' || a || '}, {\"name\": \"stop\", \"arguments\": {\"now\": true}}]'",
    "qwen": "'<tool_call>' || chr(10) || '{\"name\": \"say_' || role || '\", \"arguments\": ' || a || '}' || chr(10) || '</tool_call>' || chr(10) || '<tool_call>' || chr(10) || '{\"name\": \"stop\", \"arguments\": {\"now\": true}}' || chr(10) || '</tool_call>'",
    "minimax1": "'<tool_calls>' || chr(10) || '{\"name\": \"say_' || role || '\", \"arguments\": ' || a || '}' || chr(10) || '{\"name\": \"stop\", \"arguments\": {\"now\": true}}' || chr(10) || '</tool_calls>'",
    "minimax2": "'<invoke name=\"say_' || role || '\">' || chr(10) || '<parameter name=\"what\">' || t || '</parameter>' || chr(10) || '<parameter name=\"times\">' || turn || '</parameter>' || chr(10) || '</invoke>' || chr(10) || '<invoke name=\"stop\">' || chr(10) || '<parameter name=\"now\">true</parameter>' || chr(10) || '</invoke>'",
    "seed": "chr(10) || '<seed:tool_call>' || chr(10) || '<function=say_' || role || chr(10) || '<parameter=what>' || t || '</parameter>' || chr(10) || '<parameter=times>' || turn || '</parameter>' || chr(10) || '</function>' || chr(10) || '</seed:tool_call>' || chr(10) || chr(10) || '<seed:tool_call>' || chr(10) || '<function=stop' || chr(10) || '<parameter=now>true</parameter>' || chr(10) || '</function>' || chr(10) || '</seed:tool_call>'",
    "glm4_moe": "chr(10) || '<tool_call>say_' || role || chr(10) || '<arg_key>what</arg_key>' || chr(10) || '<arg_value>' || t || '</arg_value>' || chr(10) || '<arg_key>times</arg_key>' || chr(10) || '<arg_value>' || turn || '</arg_value>' || chr(10) || chr(10) || '<tool_call>stop' || chr(10) || '<arg_key>now</arg_key>' || chr(10) || '<arg_value>true</arg_value>'",
    "qwen35": "'<tool_call>' || chr(10) || '<function=say_' || role || '>' || chr(10) || '<parameter=what>' || chr(10) || t || chr(10) || '</parameter>' || chr(10) || '<parameter=times>' || chr(10) || turn || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>' || chr(10) || '<tool_call>' || chr(10) || '<function=stop>' || chr(10) || '<parameter=now>' || chr(10) || 'true' || chr(10) || '</parameter>' || chr(10) || '</function>' || chr(10) || '</tool_call>'",
    "lfm2": "'<|tool_call_start|>[say_' || role || '(what=\"' || t || '\", times=' || turn || '), stop(now=true)]<|tool_call_end|>'",
}


@query("tool_call_texts", "WITH c AS (SELECT *, " + _TEXT + " AS t FROM conversations WHERE text IS NOT NULL), b AS (SELECT *, '{\"what\": \"' || t || '\", \"times\": ' || turn || '}' AS a FROM c) SELECT conv_id, turn, " + ", ".join(f'{sql} AS "{k}"' for k, sql in _FORMS.items()) + " FROM b")
def tool_call_texts(spark, sf):
    """Two calls in each dialect that takes several."""
    return _calls(spark, sf, True).select("conv_id", "turn", *[T.call_text(F.col("calls"), d).alias(d) for d in _FORMS])


@query("tool_calls_back", "SELECT conv_id, turn, d AS dialect, 'say_' || role AS name, " + _TEXT + " AS what, turn AS times FROM conversations, (SELECT unnest(['default', 'glm4', 'llama3', 'minimax1', 'minimax2', 'mistral', 'qwen', 'qwen35', 'glm4_moe', 'seed', 'ling', 'lfm2']) AS d) WHERE text IS NOT NULL")
def tool_calls_back(spark, sf):
    """One call in each of the twelve dialects, taken out of its text again."""
    rows = _calls(spark, sf, False)

    def said(d):
        text = T.call_text(F.col("calls"), d)
        return F.concat(F.lit("<minimax:tool_call>\n"), text, F.lit("\n</minimax:tool_call>")) if d == "minimax2" else text

    each = F.array(*[F.struct(F.lit(d).alias("dialect"), T.extract_calls(said(d), d).alias("found")) for d in T.DIALECTS])
    x = rows.select("conv_id", "turn", F.explode(each).alias("x")).select("conv_id", "turn", "x.dialect", F.get("x.found", F.lit(0)).alias("c"))
    args = F.from_json(F.col("c.arguments"), "what string, times long")
    return x.select("conv_id", "turn", "dialect", F.col("c.name").alias("name"), args["what"].alias("what"), args["times"].alias("times"))


@query("tool_calls_absent", "SELECT conv_id, turn, 12 AS n FROM conversations WHERE text IS NOT NULL")
def tool_calls_absent(spark, sf):
    """Plain text holds no calls in any dialect."""
    c = table(spark, sf, "conversations").where("text is not null").withColumn("t", F.concat(F.lit("said: "), "text"))
    return c.select("conv_id", "turn", sum((T.extract_calls(F.col("t"), d).isNull().cast("int") for d in T.DIALECTS), F.lit(0)).alias("n"))


_TOOL_SQL = """'{"name": "say_' || role || '", "description": "' || t || '", "parameters": {"type": "object", "properties": {"what": {"type": "string", "description": "it", "enum": ["a", "b"]}, "times": {"type": "array", "items": {"type": "integer"}}}, "required": ["what"]}}'"""
_STOP_SQL = """'{"type": "function", "function": {"name": "stop", "parameters": {"type": "object", "properties": {}}}}'"""


@query("tool_descriptions", f"""WITH b AS (SELECT conv_id, turn, role, {_TEXT} AS t FROM conversations WHERE text IS NOT NULL), j AS (SELECT *, {_TOOL_SQL} AS say, {_STOP_SQL} AS stop, '{{"name": "stop", "parameters": {{"type": "object", "properties": {{}}}}}}' AS bare FROM b)
SELECT conv_id, turn, 'You have access to the following tools:' || chr(10) || '> Tool Name: say_' || role || chr(10) || 'Tool Description: ' || t || chr(10) || 'Tool Args:' || chr(10) || '  - what (string, required): it, should be one of [a, b]' || chr(10) || '  - times (array): , where each item should be integer' || chr(10) || chr(10)
  || '> Tool Name: stop' || chr(10) || 'Tool Description: ' || chr(10) || 'Tool Args:' || chr(10) || chr(10) || 'Use the following format if using a tool:' || chr(10) || '```' || chr(10) || 'Action: tool name (one of [say_' || role || ', stop])' || chr(10) || 'Action Input: the input to the tool, in a JSON format representing the kwargs (e.g. ```{{"input": "hello world", "num_beams": 5}}```)' || chr(10) || '```' || chr(10) AS "default",
  '[AVAILABLE_TOOLS] [{{"type": "function", "function": ' || say || '}}, ' || stop || '][/AVAILABLE_TOOLS]' AS mistral,
  'List of tools: <|tool_list_start|>[' || say || ', ' || bare || ']<|tool_list_end|>' AS lfm2,
  '<|im_start|>system' || chr(10) || 'Be kind.' || chr(10) || chr(10) || '# Tools' || chr(10) || chr(10) || 'You may call one or more functions to assist with the user query.' || chr(10) || chr(10) || 'You are provided with function signatures within <tools></tools> XML tags:' || chr(10) || '<tools>' || chr(10) || '{{"type": "function", "function": ' || say || '}}' || chr(10) || stop || chr(10) || '</tools>' || chr(10) || chr(10)
  || 'For each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:' || chr(10) || '<tool_call>' || chr(10) || '{{"name": <function-name>, "arguments": <args-json-object>}}' || chr(10) || '</tool_call><|im_end|>' || chr(10)
  || '<|im_start|>user' || chr(10) || 'Say it.<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<tool_call>' || chr(10) || '{{"name": "stop", "arguments": {{"times": [1, 2]}}}}' || chr(10) || '</tool_call><|im_end|>' || chr(10)
  || '<|im_start|>user' || chr(10) || '<tool_response>' || chr(10) || t || chr(10) || '</tool_response><|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS rendered FROM j""")
def tool_descriptions(spark, sf):
    """Tools described in four dialects; the last one inside turn 0 of a chat with a call and its answer."""
    from kilnspark.operators import samples as S

    c = table(spark, sf, "conversations").where("text is not null").withColumn("t", F.trim(F.regexp_replace("text", "[^A-Za-z ]+", "")))
    say = F.concat(F.lit('{"name":"say_'), "role", F.lit('","description":"'), "t", F.lit('","parameters":{"type":"object","properties":{"what":{"type":"string","description":"it","enum":["a","b"]},"times":{"type":"array","items":{"type":"integer"}}},"required":["what"]}}'))
    tools = F.concat(F.lit("["), say, F.lit(', {"type": "function", "function": {"name": "stop", "parameters": {"type": "object", "properties": {}}}}]'))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.array(turn("user", F.lit("Say it.")), turn("function", F.lit('{"name": "stop", "arguments": {"times":[1,2]}}')), turn("observation", F.col("t")))
    rows = c.withColumn("tools", tools)
    return rows.select("conv_id", "turn", *[T.tools_text(F.col("tools"), d).alias(d) for d in ("default", "mistral", "lfm2")], S.render_chat(messages, F.lit("Be kind."), "qwen", F.col("tools")).alias("rendered"))
