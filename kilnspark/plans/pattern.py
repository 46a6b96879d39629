"""Path-pattern templates: text with graph paths, planned as DataFrame joins.

A template is literal text with fields in braces:

* ``{a:Label}``, ``{a:Label.edge>b:Label2}``, ``{a:Label.edge<b:Label2.prop}``:
  a path; variables are bound where they first occur and shared by later fields.
* ``{a.prop}``: a property of a bound variable; ``[op value]`` after it
  filters (``= != < <= > >= ~``); of a list, ``[? op value]`` asks for any and
  ``[* op value]`` for all elements, and ``[n]`` is the element at place n from 0.
* ``{force a.x op b.y}``: a condition between properties.
* ``<* ... *>``: fields inside bind and filter but print nothing.

Steps become equi-joins of edges and nodes; ``force`` equalities are join
conditions that Catalyst plans; two variables of one label are different nodes unless
a force condition names both.  Values that are null, empty or ``N/A`` drop the row
unless ``allow_null``.
"""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnspark.operators.filters import all_of, any_of, compare, element, present
from kilnspark.operators.graph import Graph
from kilnspark.operators.numbering import numbered
from kilnspark.sources.workspace import materialise

_FIELD = re.compile(r"<\*|\*>|\{[^{}]*\}")
_FORCE = re.compile(r"force\s+(\w+)\.(\w+)\s*(<=|>=|!=|=|<|>|~)\s*(\w+)\.(\w+)$")
_NODE = re.compile(r"(?:(\w+):)?(\w+)$")
_STEP = re.compile(r"\.(\w+)([<>])((?:\w+:)?\w+)")
_TAIL = re.compile(r"\.(\w+)(?:\[(?:(\d+)|([?*_])?\s*(<=|>=|!=|=|<|>|~)\s*(.*))\])?$")


@dataclass(frozen=True)
class Step:
    src: str
    edge: str
    forward: bool
    dst: str


@dataclass
class Pattern:
    """Bound variables, steps, conditions, and the printed parts in order."""

    labels: dict[str, str] = field(default_factory=dict)
    steps: list[Step] = field(default_factory=list)
    filters: list[tuple[str, str, str, str]] = field(default_factory=list)
    forces: list[tuple[str, str, str, str, str]] = field(default_factory=list)
    parts: list[str | tuple[str, str]] = field(default_factory=list)
    used: set[tuple[str, str]] = field(default_factory=set)


class TemplateError(ValueError):
    """A template that can't be bound."""


def parse(text: str) -> Pattern:
    p = Pattern()
    hidden, at = 0, 0
    for m in _FIELD.finditer(text):
        if not hidden and m.start() > at:
            p.parts.append(text[at : m.start()])
        at = m.end()
        if m[0] == "<*":
            hidden += 1
        elif m[0] == "*>":
            if not hidden:
                raise TemplateError("*> without <*")
            hidden -= 1
        else:
            _field(p, m[0][1:-1].strip(), bool(hidden))
    if hidden:
        raise TemplateError("<* without *>")
    if at < len(text):
        p.parts.append(text[at:])
    if not p.labels:
        raise TemplateError("a template needs a path")
    return p


def _bind(p: Pattern, spec: str) -> str:
    m = _NODE.match(spec)
    if not m:
        raise TemplateError(f"not a node: {spec}")
    name, label = m[1], m[2]
    if name is None and label in p.labels:
        return label
    name = name or label
    if p.labels.setdefault(name, label) != label:
        raise TemplateError(f"{name} is bound to {p.labels[name]}")
    return name


def _field(p: Pattern, body: str, hidden: bool) -> None:
    if body.startswith("force "):
        m = _FORCE.match(body)
        if not m:
            raise TemplateError(f"not a condition: {body}")
        if m[1] not in p.labels or m[4] not in p.labels:
            raise TemplateError(f"unbound variable in {body}")
        p.forces.append((m[1], m[2], m[3], m[4], m[5]))
        p.used |= {(m[1], m[2]), (m[4], m[5])}
        return
    head = re.match(r"(?:\w+:)?\w+", body)
    if not head:
        raise TemplateError(f"not a path: {body}")
    here, at = _bind(p, head[0]), head.end()
    while m := _STEP.match(body, at):
        there = _bind(p, m[3])
        step = Step(here, m[1], m[2] == ">", there)
        if step not in p.steps:
            p.steps.append(step)
        here, at = there, m.end()
    if at == len(body):
        return
    m = _TAIL.match(body, at)
    if not m:
        raise TemplateError(f"not a property: {body[at:]}")
    if m[2]:
        printed = f"{m[1]}[{m[2]}]"
        p.used.add((here, printed))
        p.parts += [] if hidden else [(here, printed)]
        return
    if m[4]:
        p.filters.append((here, m[1], (m[3] or "") + m[4], m[5].strip("'\" ")))
    if not (m[3] or "").strip("_"):  # a condition on a list prints nothing
        p.used.add((here, m[1]))
        p.parts += [] if hidden else [(here, m[1])]


def _name(var: str, prop: str) -> str:
    return f"{var}__{prop}"


def _property(prop: str) -> Column:
    """A property, or the element of a list at a place (``name[0]``)."""
    name, _, place = prop.rstrip("]").partition("[")
    return element(F.col(name), int(place)) if place else F.col(name)


def _nodes(graph: Graph, p: Pattern, var: str, allow_null: bool) -> DataFrame:
    """Nodes a variable may be: its own filters hold and its used properties are there."""
    if p.labels[var] not in graph.nodes:
        raise TemplateError(f"no label {p.labels[var]}")
    df = graph.nodes[p.labels[var]]
    for v, prop, op, value in p.filters:
        if v == var:
            test = {"?": any_of, "*": all_of}.get(op[0], compare)
            df = df.where(test(F.col(prop), op.lstrip("?*_"), value))
    wanted = sorted(prop for v, prop in p.used if v == var)
    if not allow_null:
        for prop in wanted:
            df = df.where(present(_property(prop).cast("string")))
    return df.select(F.col("id").alias(_name(var, "id")), *[_property(x).alias(_name(var, x)) for x in wanted if x != "id"])


def _edges(graph: Graph, p: Pattern, step: Step) -> DataFrame:
    if step.edge not in graph.edges:
        raise TemplateError(f"no edge {step.edge}")
    src, dst, rows = graph.edges[step.edge]
    a, b = (step.src, step.dst) if step.forward else (step.dst, step.src)
    if (p.labels[a], p.labels[b]) != (src, dst):
        raise TemplateError(f"{step.edge} leads from {src} to {dst}")
    return rows.select(F.col("src").alias(_name(a, "id")), F.col("dst").alias(_name(b, "id")))


def _conditions(p: Pattern, bound: set[str], now: set[str]) -> list[Column]:
    """What must hold between bound variables, of which one of ``now`` is the last to be bound."""
    out = [compare(F.col(_name(a, x)), op, F.col(_name(b, y))) for a, x, op, b, y in p.forces if {a, b} <= bound and {a, b} & now]
    forced = {frozenset((a, b)) for a, _, _, b, _ in p.forces}
    order = list(p.labels)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if p.labels[a] == p.labels[b] and {a, b} <= bound and {a, b} & now and frozenset((a, b)) not in forced:
                out.append(F.col(_name(a, "id")) != F.col(_name(b, "id")))
    return out


def bindings(graph: Graph, p: Pattern, allow_null: bool = False, start: tuple[str, DataFrame] | None = None) -> DataFrame:
    """One row for each binding: ``var__id`` and the used properties.

    ``start`` is a variable and the few ``id`` it may have: joins begin there, and
    nothing is expanded from any other node.  Conditions are applied as soon as their
    variables are bound.  Disjoint paths multiply: that is what such a template means.
    """
    bound: set[str] = set()
    out: DataFrame | None = None
    todo = list(p.steps)
    order = list(p.labels)
    if start is not None:
        order.sort(key=lambda v: v != start[0])

    def add(part: DataFrame, keys: list[str]) -> None:
        nonlocal out
        out = part if out is None else out.join(part, keys) if keys else out.crossJoin(part)

    def bind(var: str, keys: list[str]) -> None:
        nonlocal out
        rows = _nodes(graph, p, var, allow_null)
        if start is not None and var == start[0]:
            rows = rows.join(F.broadcast(start[1].select(F.col("id").alias(_name(var, "id")))), _name(var, "id"), "left_semi")
        add(rows, keys)
        bound.add(var)
        for test in _conditions(p, bound, {var}):
            out = out.where(test)

    while todo or any(v not in bound for v in order):
        # a step that touches what is bound comes first, so that cross products come last
        step = next((s for s in todo if s.src in bound or s.dst in bound), None)
        if step is None:
            # paths that share nothing with what is bound, or variables alone
            bind(next(v for v in order if v not in bound), [])
            continue
        todo.remove(step)
        add(_edges(graph, p, step), [_name(v, "id") for v in dict.fromkeys((step.src, step.dst)) if v in bound])
        for v in (step.src, step.dst):
            if v not in bound:
                bind(v, [_name(v, "id")])
    return out


def render(p: Pattern) -> Column:
    return F.concat(*[F.lit(x) if isinstance(x, str) else F.coalesce(F.col(_name(*x)).cast("string"), F.lit("")) for x in p.parts])


#: Rows of each side in a tile of a product: a task holds one side of a tile, and writes a tile or a few.
TILE = 4096


def _part(p: Pattern, names: set[str]) -> Pattern:
    """What a pattern says about some of its variables."""
    out = Pattern({v: p.labels[v] for v in p.labels if v in names}, [s for s in p.steps if {s.src, s.dst} <= names], [f for f in p.filters if f[0] in names])
    out.forces, out.used = [f for f in p.forces if {f[0], f[3]} <= names], {u for u in p.used if u[0] in names}
    return out


def _meeting(p: Pattern) -> tuple[str, set[str], set[str]] | None:
    """A variable that isn't printed, and two sets of variables that have nothing in common but it; texts of both sides are printed.

    None if there is no such variable, or if two printed properties stand side by side.
    """
    printed = {x[0] for x in p.parts if not isinstance(x, str)}
    inner = p.parts[next((i for i, x in enumerate(p.parts) if not isinstance(x, str)), 0) :]
    if any(not isinstance(x, str) and not isinstance(y, str) for x, y in zip(inner, inner[1:])):
        return None
    forced = {frozenset((f[0], f[3])) for f in p.forces}
    alike = [{a, b} for a in p.labels for b in p.labels if a < b and p.labels[a] == p.labels[b] and frozenset((a, b)) not in forced]
    ties = [{s.src, s.dst} for s in p.steps] + [set(f) for f in forced] + alike
    for v in (x for x in p.labels if x not in printed):
        groups: list[set[str]] = []
        for name in p.labels:
            if name != v and not any(name in g for g in groups):
                group = {name}
                while more := {x for t in ties if v not in t and t & group for x in t} - group:
                    group |= more
                groups.append(group)
        near = lambda g: any(v in (s.src, s.dst) and {s.src, s.dst} & g for s in p.steps)
        told = [g for g in groups if g & printed]
        if len(told) > 1 and all(near(g) for g in groups):
            rest = set().union(*[g for g in groups if g is not told[0]])
            return v, told[0], rest
    return None


def _met(graph: Graph, p: Pattern, v: str, left: set[str], right: set[str], allow_null: bool) -> DataFrame:
    """Different texts of two sides that meet in ``v``, of which no more is shuffled than the sides.

    Each side is its different printed values by ``v``.  Two values make one text wherever they meet, so only what
    occurs with several ``v`` on both sides can give it twice.  Values that hold the first sign of a literal
    between values may be cut in other places.  Texts of such values alone go through a DISTINCT; the others are a
    product in tiles, and each of them comes once.
    """
    printed = list(dict.fromkeys(x for x in p.parts if not isinstance(x, str)))
    first, last = (i[k] for i in [[i for i, x in enumerate(p.parts) if not isinstance(x, str)]] for k in (0, -1))
    signs = {x[0] for x in p.parts[first:last] if isinstance(x, str)}
    key = _name(v, "id")
    spark = graph.nodes[p.labels[v]].sparkSession

    def side(names: set[str], kind: str) -> DataFrame:
        columns = [_name(*x) for x in printed if x[0] in names]
        rows = bindings(graph, _part(p, names | {v}), allow_null).select(key, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).distinct()
        rows = materialise(rows)
        many = rows.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
        cut = F.lit(False)
        for c in columns:
            for sign in signs:
                cut = cut | F.contains(F.col(c), F.lit(sign))
        return materialise(rows.join(many, columns, "left").select(key, *columns, F.when(cut, "cut").when(F.col("_n").isNotNull(), "many").otherwise("once").alias(kind)))

    a, b = side(left, "_a"), side(right, "_b")
    counts = a.groupBy(key, "_a").agg(F.count("*").alias("_n")).join(b.groupBy(key, "_b").agg(F.count("*").alias("_m")), key)
    # nine rows at most
    sizes = counts.groupBy("_a", "_b").agg(F.sum(F.col("_n").cast("double") * F.col("_m")).alias("pairs")).collect()

    def hot(rows: DataFrame, name: str) -> DataFrame:
        # at most one in TILE of the rows
        return F.broadcast(rows.groupBy(key).agg(F.ceil(F.count("*") / TILE).cast("int").alias(name)).where(F.col(name) > 1))

    def product(x: DataFrame, y: DataFrame, pairs: float) -> DataFrame:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * int(pairs / TILE**2))
        over = lambda name: F.coalesce(F.col(name), F.lit(1))
        spread = lambda rows, mine, other: (
            rows.join(hot(x, "_i"), key, "left").join(hot(y, "_j"), key, "left")
            .select(key, *[c for c in rows.columns if c != key], F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), over(mine)).cast("int").alias(f"{mine}_at"), F.explode(F.sequence(F.lit(0), over(other) - 1)).alias(f"{other}_at"))
            .repartition(parts, key, "_i_at", "_j_at")
        )
        return spread(x, "_i", "_j").join(spread(y, "_j", "_i").hint("merge"), [key, "_i_at", "_j_at"]).select(render(p).alias("text"))

    once, again = [], []
    for r in sizes:
        single = "cut" not in (r["_a"], r["_b"]) and "once" in (r["_a"], r["_b"])
        (once if single else again).append(product(a.where(F.col("_a") == r["_a"]).drop("_a"), b.where(F.col("_b") == r["_b"]).drop("_b"), r["pairs"]))
    out = spark.createDataFrame([], "text string")
    for each in once + ([reduce(DataFrame.union, again).distinct()] if again else []):
        out = out.union(each)
    return out


def run(graph: Graph, template: str, limit: int | None = None, order: str | None = None, seed: str | None = None, distinct: bool = True, allow_null: bool = False) -> DataFrame:
    """Rendered texts: DISTINCT, then ORDER (a seed draws), then LIMIT."""
    p = parse(template)
    meeting = _meeting(p) if distinct and not order else None
    if meeting:
        out = _met(graph, p, *meeting, allow_null)
    else:
        out = bindings(graph, p, allow_null).select(render(p).alias("text"), *([F.col(order.replace(".", "__")).alias("_order")] if order else []))
        out = out.distinct() if distinct else out
    if seed is not None:
        out = out.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "text")), "text")
    elif order:
        out = out.orderBy("_order", "text")
    out = out.select("text")
    return out if limit is None else out.limit(limit)


#: Drawn rows up to which they are broadcast to the edges: what they hold is ids and printed properties.
BROADCAST_DRAWS = 100_000


def _hash(seed: str, *cols: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in cols]))


def drawn_primaries(graph: Graph, p: Pattern, primary: str, n: int, seed: str) -> DataFrame:
    """``(id)``: ``n`` different nodes of the primary's label, the least by hash, drawn before anything is expanded."""
    if primary not in p.labels:
        raise TemplateError(f"{primary} is not bound")
    return graph.nodes[p.labels[primary]].select("id").orderBy(_hash(seed, F.col("id")), "id").limit(n)


def sample_distinct(graph: Graph, template: str, primary: str, n: int, seed: str, limit: int | None = None, allow_null: bool = False) -> DataFrame:
    """All texts of ``n`` drawn primaries: DISTINCT, drawn order, LIMIT (``n`` unless given)."""
    p = parse(template)
    rows = bindings(graph, p, allow_null, (primary, drawn_primaries(graph, p, primary, n, seed)))
    return rows.select(render(p).alias("text")).distinct().orderBy(_hash(seed, F.col("text")), "text").limit(n if limit is None else limit)


def stages(p: Pattern, primary: str) -> list[tuple[Step, list[Step]]]:
    """Steps that bind one variable each, from the primary on, and the steps that are then between bound ones."""
    bound, todo, out = {primary}, list(p.steps), []
    while todo:
        step = next((s for s in todo if (s.src in bound) != (s.dst in bound)), None)
        if step is None:
            raise TemplateError(f"no path from {primary} to {todo[0].src}")
        bound |= {step.src, step.dst}
        todo.remove(step)
        closed = [s for s in todo if {s.src, s.dst} <= bound]
        todo = [s for s in todo if s not in closed]
        out.append((step, closed))
    if missing := set(p.labels) - bound:
        raise TemplateError(f"no path from {primary} to {sorted(missing)[0]}")
    return out


def sample_staged(graph: Graph, template: str, primary: str, n: int, seed: str, replace: bool = True, allow_null: bool = False) -> DataFrame:
    """``(draw, text)``: ``n`` drawn primaries, extended by one drawn neighbour at each stage.

    With replacement draw i takes the primary whose place in the order of hashes is
    its own hash; without, the i-th of them.  After each stage's join a least-hash
    aggregate keeps one neighbour for each draw, so rows never outgrow draws times
    neighbours of one node, and the product of all paths is never built.  Draws whose drawn
    nodes lead nowhere give no text, as do primaries that fail their own conditions.
    """
    p = parse(template)
    if primary not in p.labels:
        raise TemplateError(f"{primary} is not bound")
    plan, key = stages(p, primary), _name(primary, "id")
    spark = graph.nodes[p.labels[primary]].sparkSession
    if replace:
        everyone = materialise(numbered(graph.nodes[p.labels[primary]].select("id"), [_hash(seed, F.col("id")), F.col("id")], "_at"))
        total = everyone.count()
        at = F.conv(F.substring(_hash(seed, F.col("draw")), 1, 15), 16, 10).cast("long") % max(1, total)
        now = spark.range(n).select(F.col("id").alias("draw")).withColumn("_at", at).join(everyone, "_at").select("draw", F.col("id").alias(key))
    else:
        drawn = drawn_primaries(graph, p, primary, n, seed)
        now = numbered(drawn, [_hash(seed, F.col("id")), F.col("id")], "draw").select("draw", F.col("id").alias(key))
    small = F.broadcast if n <= BROADCAST_DRAWS else (lambda df: df)
    now = _nodes(graph, p, primary, allow_null).join(small(now), key)
    bound = {primary}
    for k, (step, closed) in enumerate(plan):
        old, new = (step.src, step.dst) if step.src in bound else (step.dst, step.src)
        grown = _edges(graph, p, step).join(small(now), _name(old, "id")).join(_nodes(graph, p, new, allow_null), _name(new, "id"))
        bound.add(new)
        for other in closed:
            grown = grown.join(_edges(graph, p, other), [_name(v, "id") for v in dict.fromkeys((other.src, other.dst))], "left_semi")
        for test in _conditions(p, bound, {new}):
            grown = grown.where(test)
        mine = F.col(_name(new, "id"))
        columns = [c for c in grown.columns if c != "draw"]
        least = F.min_by(F.struct(*columns), F.struct(_hash(f"{seed}|{k}", F.col("draw"), mine), mine))
        now = materialise(grown.groupBy("draw").agg(least.alias("_x")).select("draw", "_x.*"))
    return now.select("draw", render(p).alias("text"))


def run_bounded(graph: Graph, template: str, limit: int, seed: str | None = None, seconds: float = 90.0, allow_null: bool = False) -> tuple[DataFrame, bool]:
    """(texts, whether they are complete): ``run``, but no longer than ``seconds``.

    The primary query runs under a tag of its own and is interrupted when its time is
    up; then the LIMIT goes before DISTINCT, so that the first rows found are enough
    and fewer than ``limit`` texts may come.  Errors of other kinds are raised.
    """
    p = parse(template)
    rows = bindings(graph, p, allow_null).select(render(p).alias("text"))
    spark = rows.sparkSession
    order = [_hash(seed, F.col("text")), F.col("text")] if seed is not None else [F.col("text")]

    def within(df: DataFrame) -> DataFrame | None:
        tag, late = f"bounded-{uuid.uuid4().hex}", threading.Event()

        def stop() -> None:
            late.set()
            spark.sparkContext.cancelJobsWithTag(tag)

        timer = threading.Timer(seconds, stop)
        spark.sparkContext.addJobTag(tag)
        timer.start()
        try:
            return materialise(df)
        except Exception:
            if late.is_set():
                return None
            raise
        finally:
            timer.cancel()
            spark.sparkContext.removeJobTag(tag)

    found = within(rows.distinct().orderBy(*order).limit(limit))
    if found is not None:
        return found, True
    found = within(rows.limit(limit).distinct())
    if found is None:
        raise TimeoutError(f"not even {limit} rows in {seconds} seconds")
    return found, False
