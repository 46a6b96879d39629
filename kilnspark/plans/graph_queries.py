"""Queries of graph, pattern, join and gate operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kilnspark.operators import gates as T
from kilnspark.operators import graph as G
from kilnspark.plans import pattern
from kilnspark.plans.filter_queries import _LIC_SQL, license_tag
from kilnspark.registry import query, table


@query("graph_path", "SELECT c_name || ' lives in ' || n_name || ', ' || r_name || '.' AS text FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def graph_path(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{c:customer.lives_in>n:nation.part_of>r:region}*>{c.name} lives in {n.name}, {r.name}.")


@query("graph_inverse_path", "SELECT DISTINCT n_name || ' ' || c_mktsegment AS text FROM customer JOIN nation ON n_nationkey = c_nationkey")
def graph_inverse_path(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{n:nation.home_of>c:customer}*>{n.name} {c.segment}")


@query("graph_backward_path", "SELECT DISTINCT n_name || ': ' || s_name AS text FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_name <> 'FRANCE'")
def graph_backward_path(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{n:nation.based_in<s:supplier}{n.name[!= FRANCE]}*>{n.name}: {s.name}")


@query("graph_shared_variables", "SELECT DISTINCT c_name || '|' || s_name AS text FROM customer JOIN supplier ON s_nationkey = c_nationkey WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'")
def graph_shared_variables(spark, sf):
    """Two paths that meet in one nation are a natural join."""
    return pattern.run(G.star_schema(spark, sf), "<*{c:customer.lives_in>n:nation}{s:supplier.based_in>n:nation}{c.balance[> 5000]}{c.segment[= BUILDING]}*>{c.name}|{s.name}")


@query("graph_distinct_primaries", "SELECT DISTINCT a.n_name || '-' || b.n_name AS text FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey")
def graph_distinct_primaries(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{a:nation.part_of>r:region}{b:nation.part_of>r:region}*>{a.name}-{b.name}")


@query("graph_force", "SELECT DISTINCT a.n_name || '<' || b.n_name AS text FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name")
def graph_force(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{a:nation.part_of>r:region}{b:nation.part_of>r:region}{force a.name < b.name}*>{a.name}<{b.name}")


@query("graph_order_limit", "SELECT text FROM (SELECT DISTINCT c_name || ' ' || n_name AS text FROM customer JOIN nation ON n_nationkey = c_nationkey) ORDER BY md5('g1|' || text), text LIMIT 25")
def graph_order_limit(spark, sf):
    return pattern.run(G.star_schema(spark, sf), "<*{c:customer.lives_in>n:nation}*>{c.name} {n.name}", limit=25, seed="g1")


#: One order of each drawn customer, one drawn customer of each draw's nation: least hashes, stage by stage.
_STAGED = """draws AS ({draws}),
one AS (SELECT draw, n_name, c_custkey, c_name FROM (SELECT d.draw, n_name, c_custkey, c_name, row_number() OVER (PARTITION BY d.draw ORDER BY md5('g2|0|' || d.draw || '|' || c_custkey), c_custkey) AS rn
  FROM draws d JOIN nation ON n_nationkey = d.id JOIN customer ON c_nationkey = n_nationkey) WHERE rn = 1),
two AS (SELECT draw, n_name, c_name, o_orderpriority FROM (SELECT o.draw, n_name, c_name, o_orderpriority, row_number() OVER (PARTITION BY o.draw ORDER BY md5('g2|1|' || o.draw || '|' || o_orderkey), o_orderkey) AS rn
  FROM one o JOIN orders ON o_custkey = o.c_custkey WHERE o_orderstatus <> 'P') WHERE rn = 1)
SELECT draw, n_name || ': ' || c_name || ' ' || o_orderpriority AS text FROM two"""
_STAGED_TEMPLATE = "<*{n:nation.lives_in<c:customer.placed>o:order}{o.status[!= P]}*>{n.name}: {c.name} {o.priority}"


@query("graph_sample_primaries", "WITH " + _STAGED.format(draws="SELECT row_number() OVER (ORDER BY md5('g2|' || n_nationkey), n_nationkey) - 1 AS draw, n_nationkey AS id FROM nation QUALIFY draw < 10"))
def graph_sample_primaries(spark, sf):
    return pattern.sample_staged(G.star_schema(spark, sf), _STAGED_TEMPLATE, "n", 10, "g2", replace=False)


@query("graph_sample_replacement", "WITH " + _STAGED.format(draws="SELECT range AS draw, id FROM range(60) JOIN (SELECT n_nationkey AS id, row_number() OVER (ORDER BY md5('g2|' || n_nationkey), n_nationkey) - 1 AS ix FROM nation) ON ix = CAST('0x' || substring(md5('g2|' || range), 1, 15) AS BIGINT) % (SELECT count(*) FROM nation)"))
def graph_sample_replacement(spark, sf):
    return pattern.sample_staged(G.star_schema(spark, sf), _STAGED_TEMPLATE, "n", 60, "g2")


@query("graph_sample_suppliers", """WITH draws AS (SELECT range AS draw, s_suppkey FROM range(500) JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY md5('g4|' || s_suppkey), s_suppkey) - 1 AS ix FROM supplier) ON ix = CAST('0x' || substring(md5('g4|' || range), 1, 15) AS BIGINT) % (SELECT count(*) FROM supplier)),
one AS (SELECT draw, s_suppkey, s_name, n_nationkey, n_name FROM draws JOIN supplier USING (s_suppkey) JOIN nation ON n_nationkey = s_nationkey),
two AS (SELECT * FROM (SELECT o.*, b.s_name AS other, b.s_suppkey AS bk, row_number() OVER (PARTITION BY draw ORDER BY md5('g4|1|' || draw || '|' || b.s_suppkey), b.s_suppkey) AS rn FROM one o JOIN supplier b ON b.s_nationkey = o.n_nationkey AND b.s_suppkey <> o.s_suppkey) WHERE rn = 1)
SELECT draw, s_name || ' and ' || other || ' in ' || n_name AS text FROM two""")
def graph_sample_suppliers(spark, sf):
    """Another supplier of the same nation: two variables of one label differ at the stage that binds the second."""
    return pattern.sample_staged(G.star_schema(spark, sf), "<*{a:supplier.based_in>n:nation}{b:supplier.based_in>n:nation}*>{a.name} and {b.name} in {n.name}", "a", 500, "g4")


@query("graph_sample_expanded", """WITH k AS (SELECT n_nationkey, n_name FROM nation ORDER BY md5('g3|' || n_nationkey), n_nationkey LIMIT 8)
SELECT text FROM (SELECT DISTINCT n_name || ' ' || c_name AS text FROM k JOIN customer ON c_nationkey = n_nationkey) ORDER BY md5('g3|' || text), text LIMIT 8""")
def graph_sample_expanded(spark, sf):
    """Primaries are drawn first, then everything of theirs is expanded."""
    return pattern.sample_distinct(G.star_schema(spark, sf), "<*{n:nation.lives_in<c:customer}*>{n.name} {c.name}", "n", 8, "g3")


@query("graph_bounded", "SELECT text FROM (SELECT DISTINCT c_name || ' ' || o_orderpriority AS text FROM customer JOIN orders ON o_custkey = c_custkey) ORDER BY md5('g5|' || text), text LIMIT 40")
def graph_bounded(spark, sf):
    return pattern.run_bounded(G.star_schema(spark, sf), "<*{c:customer.placed>o:order}*>{c.name} {o.priority}", 40, "g5")[0]


@query("graph_census", """SELECT 'node' AS kind, 'region' AS name, count(*) AS n FROM region UNION ALL SELECT 'node', 'nation', count(*) FROM nation UNION ALL SELECT 'node', 'customer', count(*) FROM customer UNION ALL SELECT 'node', 'supplier', count(*) FROM supplier UNION ALL SELECT 'node', 'order', count(*) FROM orders
UNION ALL SELECT 'edge', 'part_of', count(*) FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'edge', 'lives_in', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT 'edge', 'based_in', count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL SELECT 'edge', 'placed', count(*) FROM orders JOIN customer ON c_custkey = o_custkey UNION ALL SELECT 'edge', 'home_of', count(*) FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def graph_census(spark, sf):
    return G.star_schema(spark, sf).census()


@query("graph_upsert", "SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN '*' ELSE '' END AS c_name FROM customer")
def graph_upsert(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return G.upsert(c, c.where("c_custkey % 3 = 0").withColumn("c_name", F.concat("c_name", F.lit("*"))), "c_custkey")


@query("graph_latest_load", "SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def graph_latest_load(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return G.latest(o, "o_custkey", F.struct("o_orderdate", "o_orderkey").desc()).select("o_custkey", "o_orderkey")


@query("graph_neighbourhood", """WITH up AS (SELECT c_custkey AS child, c_nationkey + 1000000 AS parent FROM customer), links AS (SELECT DISTINCT o_custkey AS node, o_orderpriority AS partner FROM orders),
near AS (SELECT child AS node, parent AS near FROM up UNION SELECT parent, child FROM up UNION SELECT x.child, y.child FROM up x JOIN up y USING (parent) WHERE x.child <> y.child),
p AS (SELECT n.node, list_distinct(list(partner)) AS p FROM near n JOIN links l ON l.node = n.near GROUP BY n.node), s AS (SELECT node, list_sort(list_distinct(list(partner))) AS strict FROM links GROUP BY node)
SELECT node, strict, list_sort(list_filter(coalesce(p, []), lambda x: NOT list_contains(strict, x))) AS plausible FROM s LEFT JOIN p USING (node)""")
def graph_neighbourhood(spark, sf):
    up = table(spark, sf, "customer").select(F.col("c_custkey").alias("child"), (F.col("c_nationkey") + 1000000).alias("parent"))
    links = table(spark, sf, "orders").select(F.col("o_custkey").alias("node"), F.col("o_orderpriority").alias("partner")).distinct()
    return G.neighbourhood(up, links)


@query("graph_components", "WITH RECURSIVE e AS (SELECT c_custkey AS a, c_custkey // 7 * 7 AS b FROM customer), n AS (SELECT a AS node FROM e UNION SELECT b FROM e) SELECT node, node // 7 * 7 AS component FROM n")
def graph_components(spark, sf):
    e = table(spark, sf, "customer").select(F.col("c_custkey").alias("a"), (F.floor(F.col("c_custkey") / 7) * 7).alias("b"))
    return G.components(e)


_SCHEMA_SQL = """schema_edges AS (SELECT DISTINCT 'customer' AS src_type, 'lives_in' AS type, 'nation' AS dst_type FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT DISTINCT 'nation', 'home_of', 'customer' FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT DISTINCT 'customer', 'placed', 'order' FROM orders JOIN customer ON c_custkey = o_custkey UNION ALL SELECT DISTINCT 'nation', 'part_of', 'region' FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT DISTINCT 'supplier', 'based_in', 'nation' FROM supplier JOIN nation ON n_nationkey = s_nationkey)"""


@query("graph_schema_edges", f"WITH {_SCHEMA_SQL} SELECT * FROM schema_edges")
def graph_schema_edges(spark, sf):
    """Edge types of the edges that are there."""
    return G.star_schema(spark, sf).schema_edges()


@query("graph_schema_path", f"""WITH RECURSIVE {_SCHEMA_SQL}, ways AS (SELECT src_type AS a, dst_type AS b FROM schema_edges UNION SELECT dst_type, src_type FROM schema_edges),
walk AS (SELECT 'order' AS label, ['order'] AS path UNION ALL SELECT b, list_append(path, b) FROM walk JOIN ways ON a = label WHERE NOT list_contains(path, b)), best AS (SELECT path FROM walk WHERE label = 'region' ORDER BY len(path), path LIMIT 1)
SELECT unnest(range(1, len(path) + 1))::INTEGER AS step, unnest(path) AS label FROM best""")
def graph_schema_path(spark, sf):
    return G.schema_path(G.star_schema(spark, sf).schema_edges(), "order", "region")


@query("graph_floors", """SELECT * FROM (SELECT 'customer' AS name, count(*) AS got, 100 AS floor, count(*) >= 100 AS ok FROM customer UNION ALL SELECT 'region', count(*), 6, count(*) >= 6 FROM region UNION ALL SELECT 'ghost', -1, 1, false
UNION ALL SELECT 'placed', count(*), 1000, count(*) >= 1000 FROM orders JOIN customer ON c_custkey = o_custkey UNION ALL SELECT 'customer.name over 17', count(*), 1, count(*) >= 1 FROM customer WHERE length(c_name) > 17 UNION ALL SELECT 'placed from customer.segment over 8', count(DISTINCT c_custkey), 5, count(DISTINCT c_custkey) >= 5 FROM orders JOIN customer ON c_custkey = o_custkey WHERE length(c_mktsegment) > 8)""")
def graph_floors(spark, sf):
    """Counts of labels, edges, long properties and nodes that have both, against what a build needs."""
    return T.floors(G.star_schema(spark, sf), [T.Floor(100, "customer"), T.Floor(6, "region"), T.Floor(1, "ghost"), T.Floor(1000, edge="placed"), T.Floor(1, "customer", "name", 17), T.Floor(5, "customer", "segment", 8, "placed")])


@query("join_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_resume(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query("join_val_anti", "SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations v WHERE v.conv_id % 5 = 0 AND coalesce(v.role, '') = coalesce(c.role, '') AND coalesce(v.text, '') = coalesce(c.text, ''))")
def join_val_anti(spark, sf):
    c = table(spark, sf, "conversations")
    return T.leak_overlap(c, c.where("conv_id % 5 = 0"), ["role", "text"]).select("conv_id", "turn")


@query("join_mini_benchmark", "SELECT d.doc_id, m.pos FROM documents d JOIN (SELECT sha256(text) AS h, min(doc_id) AS pos FROM documents WHERE doc_id % 10 = 3 GROUP BY 1) m ON sha256(d.text) = m.h ORDER BY pos")
def join_mini_benchmark(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    mini = d.where("doc_id % 10 = 3").groupBy("h").agg(F.min("doc_id").alias("pos"))
    return d.join(mini, "h").select("doc_id", "pos").orderBy("pos")


@query("join_backend_diff", "SELECT a.conv_id, a.turn, length(a.text) - length(b.text) AS diff, (length(a.text) > 60 AND length(b.text) > 60) AS both FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE length(a.text) <> length(b.text)")
def join_backend_diff(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("n").alias("m"))
    return c.join(nxt, ["conv_id", "turn"]).where("n <> m").select("conv_id", "turn", (F.col("n") - F.col("m")).cast("long").alias("diff"), ((F.col("n") > 60) & (F.col("m") > 60)).alias("both"))


@query("join_patch", "SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.quality = 1 THEN 'same' WHEN l.toxic = 1 THEN 'bad' ELSE 'replaced' END AS outcome, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def join_patch(spark, sf):
    j = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    o = F.when(F.col("quality").isNull(), "missing").when(F.col("quality") == 1, "same").when(F.col("toxic") == 1, "bad").otherwise("replaced")
    return j.groupBy(o.alias("outcome")).agg(F.count("*").alias("n"))


@query("join_alias_ownership", "SELECT o_custkey AS alias, min(o_orderpriority) AS owner FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY o_custkey HAVING count(*) = 1")
def join_alias_ownership(spark, sf):
    pairs = table(spark, sf, "orders").select(F.col("o_custkey").alias("alias"), "o_orderpriority").distinct()
    return pairs.groupBy("alias").agg(F.min("o_orderpriority").alias("owner"), F.count("*").alias("n")).where("n = 1").select("alias", "owner")


@query("join_alias_merge", "SELECT lower(event_type) AS k, arg_min(event_type, event_id) AS spelling FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS event_type FROM events) GROUP BY 1")
def join_alias_merge(spark, sf):
    """Case-insensitive distinct, the first spelling stays."""
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("x"))
    return e.groupBy(F.lower("x").alias("k")).agg(F.min_by("x", "event_id").alias("spelling"))


@query("join_id_overlap", r"WITH o AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[0-9]{16}')) AS id FROM documents WHERE doc_id % 2 = 0), e AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9]{16}')) AS id FROM documents WHERE doc_id % 2 = 1) SELECT count(DISTINCT doc_id) AS rows, count(DISTINCT id) AS ids FROM o WHERE id IN (SELECT id FROM e)")
def join_id_overlap(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{16}"), F.lit(0))).alias("id"))
    e = d.where("doc_id % 2 = 1").select("id").distinct()
    return d.where("doc_id % 2 = 0").join(e, "id", "left_semi").agg(F.countDistinct("doc_id").alias("rows"), F.countDistinct("id").alias("ids"))


@query("join_schema_diff", "(SELECT 'missing' AS side, c_nationkey AS k FROM customer EXCEPT SELECT 'missing', s_nationkey FROM supplier) UNION ALL (SELECT 'extra', s_nationkey FROM supplier EXCEPT SELECT 'extra', c_nationkey FROM customer)")
def join_schema_diff(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct(), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    return a.join(b, "k", "left_anti").select(F.lit("missing").alias("side"), "k").union(b.join(a, "k", "left_anti").select(F.lit("extra").alias("side"), "k"))


# ------------------------------------------------------------ gates


@query("gate_row_counts", "WITH a(axis, pattern, low, high) AS (VALUES ('one', 'src1', 5, 1000000), ('all', 'src', 1, 10), ('x', 'en', 100000000, 200000000)), n AS (SELECT source AS name FROM documents UNION ALL SELECT lang FROM documents) SELECT axis, count(name) AS rows, CASE WHEN count(name) < low THEN 'FAIL_LOW' WHEN count(name) > high THEN 'FAIL_HIGH' ELSE 'OK' END AS verdict FROM a LEFT JOIN n ON name = pattern GROUP BY axis, low, high")
def gate_row_counts(spark, sf):
    axes = spark.createDataFrame([("one", "src1", 5, 1000000), ("all", "src", 1, 10), ("x", "en", 100000000, 200000000)], "axis string, pattern string, low long, high long")
    d = table(spark, sf, "documents")
    return T.row_counts(d.select(F.col("source").alias("x")).union(d.select("lang")), "x", axes)


@query("gate_licenses", f"WITH r AS (SELECT doc_id, coalesce({_LIC_SQL}, '<MISSING>') AS tag FROM documents), k AS (SELECT tag, count(*) AS n, list_sort(list(doc_id))[1:5] AS examples FROM r GROUP BY tag) SELECT tag, n, CASE WHEN tag IN ('mit','cc0') THEN 'allowed' WHEN tag = 'cc-by-nc-4.0' THEN 'allowed-nc' WHEN tag = 'cc-by-nc-nd-4.0' THEN 'denied-nc' WHEN tag = 'gpl-3.0' THEN 'denied' ELSE 'unknown' END AS verdict, examples FROM k")
def gate_licenses(spark, sf):
    return T.licenses(table(spark, sf, "documents"), license_tag(), "doc_id")


@query("gate_letters", """WITH r AS (SELECT doc_id, list_sort(list_distinct([substring('ABCDE', 1 + doc_id % 5, 1), substring('ABCDE', 1 + (doc_id // 5) % 5, 1), substring('ABCDE', 1 + (doc_id // 25) % 5, 1)])) AS l FROM documents),
x AS (SELECT unnest(l) AS c FROM r), s AS (SELECT count(*) AS al, sum((c='A')::INT) a, sum((c='B')::INT) b, sum((c='C')::INT) c, sum((c='D')::INT) d, sum((c='E')::INT) e FROM x), k AS (SELECT array_to_string(l, '') AS c, count(*) AS n FROM r GROUP BY 1), t AS (SELECT max(n) AS most, sum(n)::BIGINT AS rows, count(*) AS combos FROM k)
SELECT rows, combos, round(100.0*a/al, 6) AS pct_A, round(100.0*b/al, 6) AS pct_B, round(100.0*c/al, 6) AS pct_C, round(100.0*d/al, 6) AS pct_D, round(100.0*e/al, 6) AS pct_E,
 (100.0*a/al BETWEEN 8 AND 32 AND 100.0*b/al BETWEEN 8 AND 32 AND 100.0*c/al BETWEEN 8 AND 32 AND 100.0*d/al BETWEEN 8 AND 32 AND 100.0*e/al BETWEEN 8 AND 32 AND 100.0*most/rows < 15 AND combos >= 20) AS ok FROM s, t""")
def gate_letters(spark, sf):
    i = F.col("doc_id")
    pick = lambda k: F.substring(F.lit("ABCDE"), (k % 5 + 1).cast("int"), F.lit(1))
    letters = F.sort_array(F.array_distinct(F.array(pick(i), pick(F.floor(i / 5)), pick(F.floor(i / 25)))))
    return T.letter_balance(table(spark, sf, "documents").select(letters.alias("l")), "l")


@query("gate_top_families", "SELECT source, lang, n FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) ORDER BY n DESC, source, lang LIMIT 10")
def gate_top_families(spark, sf):
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source", "lang").limit(10)


@query("gate_actor_floor", "SELECT lang, count(DISTINCT source) AS actors, count(DISTINCT source) >= 15 AS ok FROM documents GROUP BY lang")
def gate_actor_floor(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.countDistinct("source").alias("actors")).withColumn("ok", F.col("actors") >= 15)


@query("gate_invariants", "SELECT count(*) AS rows, count(DISTINCT sha1(text)) AS distinct_texts, sum((coalesce(trim(text), '') = '')::INT)::BIGINT AS empty_texts, count(DISTINCT doc_id) AS distinct_keys FROM documents")
def gate_invariants(spark, sf):
    return T.invariants(table(spark, sf, "documents"), "doc_id", "text")


@query("approx_tokens", "SELECT source, sum(strlen(text)) / 4.0 AS tokens FROM documents GROUP BY source")
def approx_tokens(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg((F.sum(F.octet_length("text")) / 4.0).alias("tokens"))


@query("exact_dedup", "SELECT sha1(text) AS h, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup(spark, sf):
    from kilnspark.operators.curate import exact_dup_ids

    return exact_dup_ids(table(spark, sf, "documents"), "text", "doc_id")


@query("ngram_leaks", """WITH toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i+12], ' '))) AS g FROM toks WHERE len(t) >= 13),
it AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM benchmark), ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(t) - 11), lambda i: array_to_string(t[i:i+12], ' '))) AS g FROM it WHERE len(t) >= 13),
hits AS (SELECT doc_id, item_id, count(*) AS shared FROM grams JOIN ig USING (g) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY shared DESC, item_id) AS rn FROM hits)
SELECT doc_id, max(shared) AS max_shared, count(*) AS n_items FROM r WHERE rn <= 5 GROUP BY doc_id""")
def ngram_leaks(spark, sf):
    from kilnspark.operators.curate import max_hits, ngram_hits

    return max_hits(ngram_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 13))


@query("conversation_turn_pairs", "SELECT conv_id, turn, text AS prompt, lead(text) OVER w AS response FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn) QUALIFY role = 'user' AND lead(role) OVER w = 'assistant'")
def conversation_turn_pairs(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf, "conversations").where("role <> 'system'").select("conv_id", "turn", "role", F.col("text").alias("prompt"), F.lead("text").over(w).alias("response"), F.lead("role").over(w).alias("next"))
    return c.where("role = 'user' and next = 'assistant'").select("conv_id", "turn", "prompt", "response")


@query("kl_mismatch", "WITH b AS (SELECT doc_id, lang, doc_id // 8 AS batch FROM documents) SELECT doc_id, coalesce(lag(lang) OVER w, last_value(lang) OVER (PARTITION BY batch ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS kl FROM b WINDOW w AS (PARTITION BY batch ORDER BY doc_id)")
def kl_mismatch(spark, sf):
    """The response of the batch's previous row; the first row takes the last one's."""
    b = table(spark, sf, "documents").select("doc_id", "lang", F.floor(F.col("doc_id") / 8).alias("batch"))
    w = Window.partitionBy("batch").orderBy("doc_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return b.select("doc_id", F.coalesce(F.lag("lang").over(w), F.last("lang").over(whole)).alias("kl"))
