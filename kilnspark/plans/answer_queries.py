"""Queries of answer extraction and alias scores over texts of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilnspark.functions import answers as A
from kilnspark.functions import nested as N
from kilnspark.operators import aliases as L
from kilnspark.registry import query, table


def _conv(spark, sf):
    return table(spark, sf, "conversations").where("text is not null")


_ONE_LINE = "trim(regexp_replace(text, '[^A-Za-z ]+', ' ', 'g'))"


def _one_line():
    return F.trim(F.regexp_replace("text", "[^A-Za-z ]+", " "))


@query("answer_weakness", f"""WITH c AS (SELECT conv_id, turn, {_ONE_LINE} AS t FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'CWE-' || turn WHEN 1 THEN 'CWE-2' WHEN 2 THEN 'CWE-' || conv_id END AS answer FROM c""")
def answer_weakness(spark, sf):
    """Last line with an id; ids in lower case; the line before one that only says answer."""
    t, k = F.concat(F.lit("CWE-1 is not it\n"), _one_line()), F.col("turn") % 4
    n, c = F.col("turn").cast("string"), F.col("conv_id").cast("string")
    text = F.when(k == 0, F.concat(t, F.lit("\nFinal Answer: cwe-9 or cwe-"), n, F.lit(".\n\n"))).when(k == 1, F.concat(t, F.lit("\ncwe-3, then CWE-2\nno more"))).when(k == 2, F.concat(t, F.lit("\nCWE-"), c, F.lit("\nthis is my answer\nthank you"))).otherwise(_one_line())
    return _conv(spark, sf).select("conv_id", "turn", A.weakness_answer(text).alias("answer"))


@query("answer_technique", """SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN NULL ELSE 'T' || (1000 + turn) END AS answer, CASE WHEN turn % 3 = 2 THEN 'X' WHEN turn % 3 = 1 THEN 'T' || (1000 + turn) ELSE 'T' || (2000 + turn) || ', T' || (1000 + turn) END AS listed FROM conversations WHERE text IS NOT NULL""")
def answer_technique(spark, sf):
    k = F.col("turn") % 3
    a, b = F.concat(F.lit("T"), (F.col("turn") + 1000).cast("string")), F.concat(F.lit("T"), (F.col("turn") + 2000).cast("string"))
    text = F.when(k == 0, F.concat(b, F.lit("\n"), _one_line(), F.lit("\nso "), b, F.lit(" or "), a, F.lit(".003\nok"))).when(k == 1, F.concat(_one_line(), F.lit("\n"), a)).otherwise(_one_line())
    return _conv(spark, sf).select("conv_id", "turn", A.technique_answer(text).alias("answer"), A.technique_list(text).alias("listed"))


@query("answer_mitigations", """WITH i AS (SELECT conv_id, turn, list_distinct(list_transform(range(0, turn % 4), lambda x: 'M' || (1000 + x % 2))) AS ids FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, CASE len(ids) WHEN 0 THEN '' WHEN 1 THEN 'M1000' ELSE 'M1000, M1001' END AS answer FROM i""")
def answer_mitigations(spark, sf):
    n = (F.col("turn") % 4).cast("int")
    ids = F.array_join(F.transform(F.sequence(F.lit(0), n), lambda x: F.when(x < n, F.concat(F.lit("m"), (x % 2 + 1000).cast("string"))).otherwise(_one_line())), "\n")
    return _conv(spark, sf).select("conv_id", "turn", A.mitigation_answer(ids).alias("answer"))


@query("answer_options", """SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'D' WHEN 2 THEN 'B' WHEN 3 THEN 'E' END AS answer FROM conversations WHERE text IS NOT NULL""")
def answer_options(spark, sf):
    """Stated choice over later letters, last lone letter, quoted option text, none."""
    base = F.regexp_replace(_one_line(), r"(?i)\b[a-e]\b|answer|choice|option", "x")
    prompt = F.lit("which?\nA) the first of them\nB. the second of all\nC) short\nD: the third of many\nE- the third of")
    k = F.col("turn") % 5
    text = F.when(k == 0, F.concat(base, F.lit("\nThe correct answer is (A), no: the Choice would be c\nas B was"))).when(k == 1, F.concat(base, F.lit("\n E or A or D."))).when(k == 2, F.concat(base, F.lit("\nit was The Second of All"))).when(k == 3, F.concat(base, F.lit("\nit was the third of"))).otherwise(F.concat(base, F.lit("\nshort")))
    return _conv(spark, sf).select("conv_id", "turn", A.option_answer(text, prompt).alias("answer"))


@query("answer_severity", """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:' || CASE WHEN conv_id % 2 = 0 THEN 'H' ELSE 'L' END END AS answer, CASE WHEN turn % 2 = 0 THEN 'AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:' || CASE WHEN conv_id % 2 = 0 THEN 'H' ELSE 'L' END ELSE text END AS vector FROM conversations WHERE text IS NOT NULL""")
def answer_severity(spark, sf):
    a = F.when(F.col("conv_id") % 2 == 0, "H").otherwise("L")
    text = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("CVSS:3.1/AV:P/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:N\n"), _one_line(), F.lit("\nResult: CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:"), a, F.lit("."))).otherwise(F.col("text"))
    return _conv(spark, sf).select("conv_id", "turn", A.severity_answer(text).alias("answer"), A.last_vector(text).alias("vector"))


@query("answer_multi", """SELECT conv_id, turn, CASE turn % 6 WHEN 0 THEN 'A,C' WHEN 1 THEN 'B,D' WHEN 2 THEN 'A' WHEN 3 THEN 'C,J' WHEN 4 THEN '' ELSE '' END AS answer FROM conversations WHERE text IS NOT NULL""")
def answer_multi(spark, sf):
    """Tagged object, boxed list, bare object, array in broken JSON, empty list, nothing."""
    k = F.col("turn") % 6
    t = F.regexp_replace(_one_line(), '[{}"]', "")
    text = (
        F.when(k == 0, F.concat(t, F.lit('<json_object>{"correct_answers":\n ["c. so", "A", "a"]}</json_object> $\\boxed{B}$')))
        .when(k == 1, F.concat(t, F.lit(r"so $\boxed{D, B}$")))
        .when(k == 2, F.concat(t, F.lit('{"correct_answers": ["A", null]} and so on')))
        .when(k == 3, F.concat(t, F.lit('{"why": "x", "correct_answers": ["J", "C", "C"], }.}')))
        .when(k == 4, F.concat(t, F.lit('{"correct_answers": []}')))
        .otherwise(t)
    )
    return _conv(spark, sf).select("conv_id", "turn", A.multi_answer(text).alias("answer"))


@query("answer_letters_wrapped", """SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'A,H' WHEN 1 THEN 'B,B' END AS letters FROM conversations WHERE text IS NOT NULL""")
def answer_letters_wrapped(spark, sf):
    k = F.col("turn") % 3
    text = F.when(k == 0, F.concat(F.lit('{"correct_answers": ["C"]} '), _one_line(), F.lit('<json_object> { "correct_answers": ["H", "A"] } </json_object>'))).when(k == 1, F.concat(_one_line(), F.lit('{"correct_answers":["B", "B"]}'))).otherwise(_one_line())
    return _conv(spark, sf).select("conv_id", "turn", F.array_join(A.letters_answer(text), ",").alias("letters"))


@query("answer_legacy_letter", """SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' WHEN 2 THEN 'D' WHEN 3 THEN 'A' ELSE 'X' END AS cascade,
CASE turn % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' WHEN 2 THEN 'D' WHEN 3 THEN 'A' ELSE 'zz ' || regexp_replace(lower(regexp_replace(text, '[^A-Za-z ]+', ' ', 'g')), '[a-d]', 'z', 'g') || ' zz' END AS line FROM conversations WHERE text IS NOT NULL""")
def answer_legacy_letter(spark, sf):
    t = F.regexp_replace(F.lower(F.regexp_replace("text", "[^A-Za-z ]+", " ")), "[a-d]", "z")
    k = F.col("turn") % 5
    head = F.concat(F.lit("zz "), t)
    text = F.when(k == 0, F.concat(head, F.lit("\nANSWER: B"))).when(k == 1, F.concat(head, F.lit(" \\boxed{C}\nC) it is"))).when(k == 2, F.concat(head, F.lit('\n"answers": ["D"] **D**'))).when(k == 3, F.concat(head, F.lit("\nbut A\n"))).otherwise(F.concat(head, F.lit(" zz")))
    return _conv(spark, sf).select("conv_id", "turn", A.letter_cascade(text).alias("cascade"), A.line_letter(text).alias("line"))


@query("answer_first_cve", "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'CVE-2024-' || (10000 + turn) ELSE 'NOT_FOUND' END AS cve, CASE WHEN turn % 2 = 0 THEN 'CWE-7' ELSE text END AS cwe FROM conversations WHERE text IS NOT NULL")
def answer_first_cve(spark, sf):
    text = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit(" CWE-5 cve-2024-"), (F.col("turn") + 10000).cast("string"), F.lit(" CVE-2020-1111 CVE-2021-123 CWE-7"))).otherwise(F.col("text"))
    return _conv(spark, sf).select("conv_id", "turn", A.first_cve(text).alias("cve"), A.last_weakness(text).alias("cwe"))


@query("answer_actor", f"""SELECT conv_id, turn, regexp_replace({_ONE_LINE}, ' +', ' ', 'g') AS actor FROM conversations WHERE text IS NOT NULL AND NOT regexp_matches({_ONE_LINE}, '^(?i)(final answer|answer|prediction|output|result)') AND {_ONE_LINE} <> ''""")
def answer_actor(spark, sf):
    c = _conv(spark, sf).where(~_one_line().rlike("^(?i)(final answer|answer|prediction|output|result)") & (_one_line() != ""))
    return c.select("conv_id", "turn", A.actor_answer(F.concat(F.lit("before\nAnswer:  \""), _one_line(), F.lit("\"\n \n"))).alias("actor"))


@query("gold_letters", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'B' WHEN 2 THEN '' ELSE '' END AS letter FROM part")
def gold_letters(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    ident = F.concat(F.lit("T"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"))
    gold = F.when(k == 0, " c ").when(k == 1, ident).when(k == 2, "same").otherwise("T0")
    options = {"A": F.lit("x same"), "B": F.concat(F.lit("is "), ident, F.lit(" here")), "C": F.concat(ident, F.lit("1 same")), "D": F.lit(None).cast("string")}
    return p.select("p_partkey", A.gold_letter(gold, options).alias("letter"))


@query("named_actors", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Group ' || source WHEN 1 THEN source END AS actor FROM documents""")
def named_actors(spark, sf):
    k = F.col("doc_id") % 4
    d = table(spark, sf, "documents")
    name = F.when(k == 0, "AB.1").when(k == 1, "JS.1").when(k == 2, "JS.1").otherwise("AB.IE")
    body = F.substring(F.coalesce("text", F.lit("")), 1, 200)
    text = F.when(k == 0, F.concat(body, F.lit("\nTherefore, the adversary is Group "), "source", F.lit(".\n"))).when(k == 1, F.concat(F.lit('{"actor" : "'), "source", F.lit(' "}'))).when(k == 2, F.lit('{"actor": "INSUFFICIENT_EVIDENCE"}')).otherwise(F.lit("Therefore, the adversary is me."))
    return d.select("doc_id", A.named_actor(name, text, ["AB.1"], ["JS.1"]).alias("actor"))


# ------------------------------------------------------------ options

_ORDER = "WITH r AS (SELECT item_id, text, unnest(range(0, {n})) AS i FROM benchmark), s AS (SELECT item_id, text, i, row_number() OVER (PARTITION BY item_id ORDER BY md5('{seed}|' || item_id || '|' || i)) AS pos FROM r)"


@query("shuffle_rendered", _ORDER.format(n=5, seed="z") + """ SELECT item_id, CASE WHEN item_id % 3 = 2 THEN 'Read this' || chr(10) || 'A) of the text' || chr(10) || text ELSE 'Read this' || chr(10) || 'A) of the text' || chr(10) || text || chr(10) || string_agg(chr(CAST(64 + pos AS INT)) || ') option ' || i, chr(10) ORDER BY pos) || chr(10) || 'Answer' || chr(10)
|| CASE WHEN item_id % 3 = 0 THEN 'Therefore, ' || chr(CAST(64 + max(CASE WHEN i = 3 THEN pos END) AS INT)) || '.' ELSE '{"answer": "' || chr(CAST(64 + max(CASE WHEN i = 3 THEN pos END) AS INT)) || '"}' END END AS shuffled FROM s GROUP BY item_id, text""")
def shuffle_rendered(spark, sf):
    """Five options before either marker; a text without a marker stays."""
    k = F.col("item_id") % 3
    head = F.concat(F.lit("Read this\nA) of the text\n"), "text")
    block = F.lit("\n" + "\n".join(f"{c}) option {i}" for i, c in enumerate("ABCDE")) + "\nAnswer\n")
    text = F.when(k == 0, F.concat(head, block, F.lit("Therefore, D."))).when(k == 1, F.concat(head, block, F.lit('{"answer": "D"}'))).otherwise(head)
    return table(spark, sf, "benchmark").select("item_id", A.shuffle_rendered(text, F.col("item_id"), "z").alias("shuffled"))


@query("shuffle_multi", _ORDER.format(n=6, seed="m") + " SELECT item_id, string_agg('option ' || i, ';' ORDER BY pos) AS options, array_to_string(list_sort(list(chr(CAST(64 + pos AS INT))) FILTER (WHERE i IN (0, 4))), '') AS letters FROM s GROUP BY item_id")
def shuffle_multi(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", A.shuffle_multi(F.array(*[F.lit(f"option {i}") for i in range(6)]), F.array(F.lit("A"), F.lit("E")), F.col("item_id"), "m").alias("x"))
    return b.select("item_id", F.array_join("x.options", ";").alias("options"), F.array_join("x.letters", "").alias("letters"))


@query("make_questions", _ORDER.format(n=5, seed="k") + """ SELECT item_id, text || chr(10) || string_agg(chr(CAST(64 + pos AS INT)) || ') ' || ['yes', 'no ' || item_id, 'None of the above', 'All of the above', 'Both A and B'][i + 1], chr(10) ORDER BY pos) AS input, 'Because. Therefore, ' || chr(CAST(64 + max(CASE WHEN i = 0 THEN pos END) AS INT)) || '.' AS output FROM s GROUP BY item_id, text""")
def make_questions(spark, sf):
    foil = F.concat(F.lit("no "), F.col("item_id").cast("string"))
    x = A.make_question(F.col("text"), F.lit("yes"), F.array(F.lit("yes"), foil), F.lit("Because."), F.col("item_id"), "k")
    return table(spark, sf, "benchmark").select("item_id", x.alias("x")).select("item_id", "x.input", "x.output")


@query("rewrite_choices", _ORDER.format(n=4, seed="w") + """ SELECT item_id, CASE WHEN item_id % 4 = 3 THEN text ELSE text || chr(10) || string_agg(chr(CAST(64 + pos AS INT)) || ') body ' || i, chr(10) ORDER BY pos) END AS input, CASE WHEN item_id % 4 = 3 THEN 'Therefore, B.' ELSE 'Answer: ' || chr(CAST(64 + max(CASE WHEN i = CASE WHEN item_id % 4 = 1 THEN 2 ELSE 0 END THEN pos END) AS INT)) END AS output FROM s GROUP BY item_id, text""")
def rewrite_choices(spark, sf):
    k = F.col("item_id") % 4
    text = F.when(k == 3, F.col("text")).otherwise(F.concat("text", F.lit("\n" + "\n".join(f"{c}) body {i}" for i, c in enumerate("ABCD")))))
    output = F.when(k == 3, "Therefore, B.").when(k == 1, "It fits. Therefore, C.").otherwise("no statement")
    return table(spark, sf, "benchmark").select("item_id", A.rewrite_choice(text, output, F.col("item_id"), "w").alias("x")).select("item_id", "x.input", "x.output")


@query("join_aliases", "SELECT n_nationkey, n_name || j || 'x' || j || n_nationkey AS names FROM (SELECT *, [', ', ' / ', '; ', ' aka '][1 + CAST('0x' || substr(md5('a|' || n_nationkey), 1, 8) AS BIGINT) % 4] AS j FROM nation)")
def join_aliases(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", A.join_aliases(F.array("n_name", F.lit("x"), F.col("n_nationkey").cast("string")), F.col("n_nationkey"), "a").alias("names"))


# ------------------------------------------------------------ nested data


@query("navigate_paths", """SELECT conv_id, CAST(count(*) AS INT) AS n_all, min(CASE WHEN turn >= 1 THEN turn END) AS first_late, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id""")
def navigate_paths(spark, sf):
    """All elements, the first that yields something, a number."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.array_compact(F.array(F.when(F.col("turn") >= 1, F.struct(F.col("turn").alias("n"))))).alias("late"))
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "late"))).alias("m"))
    return g.select("conv_id", F.size(A.navigate(F.col("m"), "*/role")).alias("n_all"), F.get(A.navigate(F.col("m"), "?/late/*/n"), F.lit(0)).alias("first_late"), F.get(A.navigate(F.col("m"), "0/role"), F.lit(0)).alias("first_role"))


@query("find_key_path", "SELECT item_id, CASE item_id % 3 WHEN 0 THEN 'b/1/wanted' WHEN 1 THEN 'wanted' END AS path FROM benchmark")
def find_key_path(spark, sf):
    k = F.col("item_id") % 3
    doc = F.when(k == 0, F.concat(F.lit('{"a": "wanted", "b": [{}, {"wanted": '), F.to_json(F.struct("text")), F.lit("}]}"))).when(k == 1, '{"wanted": {"wanted": 1}}').otherwise("{broken")
    return table(spark, sf, "benchmark").select("item_id", N.find_key(doc, "wanted").alias("path"))


# ------------------------------------------------------------ aliases


def _actors(spark, sf):
    """Suppliers are aliases of their nation's group; groups are related to the next but at every fifth."""
    s = table(spark, sf, "supplier").select(F.concat(F.lit("Group "), F.col("s_nationkey").cast("string")).alias("actor"), F.col("s_name").alias("alias"))
    n = table(spark, sf, "nation").where("n_nationkey % 5 <> 4").select(F.concat(F.lit("group "), F.col("n_nationkey").cast("string")).alias("actor"), F.concat(F.lit("GROUP "), (F.col("n_nationkey") + 1).cast("string")).alias("other"))
    return L.alias_edges(s, "actor", "alias"), L.alias_edges(n, "actor", "other")


_GUESS = "(s_nationkey + [0, 1, 7][1 + s_suppkey % 3]) % 25"


@query("alias_resolve", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN lower(s_name) WHEN 1 THEN lower(s_name) ELSE 'nobody known ' || s_suppkey END AS actor FROM supplier")
def alias_resolve(spark, sf):
    aliases, _ = _actors(spark, sf)
    k = F.col("s_suppkey") % 3
    text = F.when(k == 0, F.concat(F.lit("  "), "s_name")).when(k == 1, F.concat(F.lit("Therefore group 1, rather ("), "s_name", F.lit(")."))).otherwise(F.concat(F.lit("Nobody known "), F.col("s_suppkey").cast("string")))
    return L.resolve(table(spark, sf, "supplier").select("s_suppkey", text.alias("t")), "s_suppkey", "t", L.alias_keys(aliases))


def _guesses(spark, sf):
    aliases, related = _actors(spark, sf)
    s = table(spark, sf, "supplier")
    gold = F.concat(F.lit("group "), ((F.col("s_nationkey") + F.element_at(F.array(F.lit(0), F.lit(1), F.lit(7)), (F.col("s_suppkey") % 3 + 1).cast("int"))) % 25).cast("string"))
    texts = s.select("s_suppkey", gold.alias("gold"), F.concat(F.lit("the adversary is "), "s_name", F.lit(".")).alias("t"))
    found = texts.join(L.resolve(texts, "s_suppkey", "t", L.alias_keys(aliases)), "s_suppkey")
    return found, aliases, related


_LINK = f"CASE WHEN s_nationkey = {_GUESS} AND {_GUESS} IN (SELECT s_nationkey FROM supplier) THEN 'C' WHEN s_nationkey // 5 = ({_GUESS}) // 5 THEN 'P' ELSE 'I' END"


@query("actor_scores", f"WITH c AS (SELECT s_suppkey, {_LINK} AS c FROM supplier) SELECT s_suppkey, c AS connection, CAST(c = 'C' AS INT) AS correct, CAST(c <> 'I' AS INT) AS plausible, CASE c WHEN 'C' THEN 1.0 WHEN 'P' THEN 0.5 ELSE 0.0 END AS combined FROM c")
def actor_scores(spark, sf):
    found, aliases, related = _guesses(spark, sf)
    c = L.connection(found.select("s_suppkey", "gold", "actor"), "gold", "actor", aliases, related)
    return c.select("s_suppkey", "connection", *[v.alias(k) for k, v in L.actor_scores(F.col("connection")).items()])


@query("actor_accuracy_legacy", f"WITH c AS (SELECT {_LINK} AS c FROM supplier UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'I' ELSE 'C' END FROM supplier) SELECT 100.0 * sum(CAST(c = 'C' AS INT)) / count(*) AS correct, 100.0 * sum(CAST(c <> 'I' AS INT)) / count(*) AS plausible FROM c")
def actor_accuracy_legacy(spark, sf):
    """Equal names count only if an alias leads back: even suppliers guess an unknown name that is its own answer."""
    found, aliases, related = _guesses(spark, sf)
    same = table(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "lone wolf").otherwise(F.lower("s_name")).alias("gold")).withColumn("actor", F.col("gold"))
    pairs = found.select("s_suppkey", "gold", "actor").unionByName(same)
    return L.actor_accuracy(L.connection(pairs, "gold", "actor", aliases, related, legacy=True), "connection")


@query("canonical_scores", """SELECT s_suppkey, CAST(s_suppkey % 4 < 2 AS INT) AS correct, CAST(s_suppkey % 4 < 3 AS INT) AS plausible, CASE WHEN s_suppkey % 4 < 2 THEN 1.0 WHEN s_suppkey % 4 = 2 THEN 0.5 ELSE 0.0 END AS combined FROM supplier""")
def canonical_scores(spark, sf):
    """Name in the text, code in the text, an alias in the text, another name that only holds the answer as a part."""
    aliases, _ = _actors(spark, sf)
    gold = F.concat(F.lit("Group "), F.col("s_nationkey").cast("string"))
    k = F.col("s_suppkey") % 4
    pred = F.when(k == 0, F.concat(F.lit("it is ("), gold, F.lit(")"))).when(k == 1, F.lit("that is g0032, sure")).when(k == 2, F.concat(F.lit("it is "), "s_name")).otherwise(F.concat(gold, F.lit("00x")))
    rows = table(spark, sf, "supplier").select("s_suppkey", pred.alias("p"), gold.alias("g"), F.lit("G0032").alias("c"))
    return L.canonical_scores(rows, "s_suppkey", "p", "g", "c", aliases)


@query("weakness_accuracy", "SELECT 100.0 * sum(CAST(doc_id % 3 = 0 AS INT)) / sum(CAST(doc_id % 3 <> 2 AS INT)) AS accuracy, sum(CAST(doc_id % 3 <> 2 AS INT))::BIGINT AS valid FROM documents")
def weakness_accuracy(spark, sf):
    k = F.col("doc_id") % 3
    gold = F.concat(F.lit("CWE-"), F.col("doc_id").cast("string"))
    return L.weakness_accuracy(table(spark, sf, "documents").select(gold.alias("g"), F.when(k == 0, F.lower(gold)).when(k == 1, "CWE-x").otherwise("none").alias("p")), "p", "g")


@query("answer_nested", """SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'A,D' WHEN 1 THEN 'B' WHEN 2 THEN 'C,E' ELSE '' END AS answer FROM conversations WHERE text IS NOT NULL""")
def answer_nested(spark, sf):
    """The first balanced object: objects within it, braces and quotes in strings, one that never closes."""
    k, t = F.col("turn") % 4, F.regexp_replace(_one_line(), '[{}"\\\\]', "")
    quoted = F.concat(F.lit('{"why": "'), t, F.lit(' a } and a \\" {", '))
    text = (
        F.when(k == 0, F.concat(t, F.lit('{"why": {"steps": [{"n": 1}]}, "correct_answers": ["D", "A"]} {"correct_answers": ["B"]}')))
        .when(k == 1, F.concat(t, quoted, F.lit('"correct_answers": ["B"]} so'), t))
        .when(k == 2, F.concat(t, F.lit('<json_object> so {"x": {"y": "}"}, "correct_answers": ["E", "C"]} </json_object>{"correct_answers": ["A"]}')))
        .otherwise(F.concat(t, F.lit('{"a": {"b": 1}')))
    )
    return _conv(spark, sf).select("conv_id", "turn", A.multi_answer(text).alias("answer"))
