"""Repair of conversation structure: cheapest edits to alternating turns, computed along a shared prefix trie.

``signatures`` streams each conversation's turns in order and writes one symbol
a turn: ``d`` for a turn that must go (blank, or a repeat of an earlier role and
text), else ``s``, ``u``, ``a`` or ``x`` for the role's initial, in upper case
if the text ends unfinished.  ``repairs`` deals the conversations by ranges of
(signature, conversation), so that equal beginnings lie side by side and a hot
signature is spread over several ranges; each range walks its sorted signatures
as a depth-first pass over their prefix trie.  A layer of the dynamic programme
is computed once for each trie node, and answers are emitted at terminal nodes.
``rewritten`` streams the turns once more beside their edits and hashes the result.

States are what has been given so far: nothing, ``s``, a ``u``, an ``a``.  A
layer keeps each state's cost and the order of the states' edit strings.  Edits
before and at a turn form a token ``I*[KDR]``; no token begins another, so two
strings over the same number of turns differ before either ends, and keeping
the least string of each state is exact.  Layers that differ by a constant cost
are the same class; states that can't win any more are dropped, so classes are
few and a step is a look-up.

A conversation's texts are streamed, never held; what is held of a conversation
is a symbol and a hash of 16 bytes a turn.  Its repaired text is one SHA-256
chain and its audit one value, hence one task reads a conversation's turns.

Defined cases: null roles and texts read as one space, as do null ids and turns
in the key of the damage; turns of equal number are ordered by role and text,
repeats stand beside their row; null turns come first; rows without
conversation id form one conversation without id; conversations of which no row
is left have zeros, no edits and the hash of nothing; an empty table has no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnspark.llm.common import materialise, parts, table

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
#: Answers, or characters of them, that a task holds before it hands them on.
BATCH_ROWS, BATCH_CHARS = 4096, 4 << 20

_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_TOLD = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
_REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FINAL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# --- the programme over symbols


def _given(state: int, initial: str) -> int | None:
    """The state after a turn of that role, if it may follow."""
    if initial == "s":
        return _SYSTEM if state == _NOTHING else None
    if initial == "u":
        return _USER if state != _USER else None
    return _ASSISTANT if initial == "a" and state == _USER else None


def _next_role(state: int) -> str:
    return "assistant" if state == _USER else "user"


def _tokens(state: int, symbol: str) -> Iterator[tuple[int, str, int]]:
    """(cost, token, state after it) for one turn.  More insertions would come back to a state already met."""
    extra = UNFINISHED if symbol.isupper() else 0
    for inserted in range(3 if state in (_NOTHING, _SYSTEM) else 2):
        spent, marks = INSERT * inserted, "I" * inserted
        yield spent + DELETE, f"{marks}D", state
        if symbol != "d":
            kept = _given(state, symbol.lower())
            if kept is not None:
                yield spent + extra, f"{marks}K", kept
            yield spent + extra + REROLE, f"{marks}R", _given(state, _next_role(state)[0])
        state = _given(state, _next_role(state)[0])


#: A layer: for each state its cost above the least one and its place in the order of edit strings, or None.
Layer = tuple
_START: Layer = ((0, 0), None, None, None)


def _step(layer: Layer, symbol: str) -> tuple[Layer, int, tuple]:
    """The layer after one more turn, what all its costs gain, and each state's (state before, token)."""
    best: dict[int, tuple[int, int, str, int]] = {}
    for state, known in enumerate(layer):
        if known is None:
            continue
        for cost, token, after in _tokens(state, symbol):
            way = (known[0] + cost, known[1], token, state)
            if after not in best or way < best[after]:
                best[after] = way
    # what another state reaches at less cost, whatever follows, is dropped: so differences stay small and classes few
    spent = {q: way[0] for q, way in best.items()}
    bounds = {_NOTHING: spent[_ASSISTANT] + DELETE, _SYSTEM: spent[_ASSISTANT], _USER: spent[_ASSISTANT] + INSERT, _ASSISTANT: spent[_USER] + INSERT}
    best = {q: way for q, way in best.items() if way[0] <= bounds[q]}
    least = min(way[0] for way in best.values())
    order = sorted(best, key=lambda q: best[q][1:3])
    made = tuple((best[q][0] - least, order.index(q)) if q in best else None for q in range(4))
    return made, least, tuple((best[q][3], best[q][2]) if q in best else None for q in range(4))


class PrefixTrie:
    """The path of the trie that the sorted signatures are on; layers above a fork are kept, not computed again."""

    _missing = {_NOTHING: "", _SYSTEM: "II", _USER: "I", _ASSISTANT: ""}

    def __init__(self) -> None:
        self.steps: dict[tuple[Layer, str], tuple[Layer, int, tuple]] = {}
        self.word, self.answered = "", None
        self.layers: list[tuple[Layer, int]] = [(_START, 0)]
        self.ways: list[tuple] = []
        self.computed = 0

    def answer(self, signature: str) -> tuple[int, str]:
        """(cost, audit); signatures should come in order."""
        if self.answered is not None and signature == self.word:
            return self.answered
        shared = len(os.path.commonprefix([self.word, signature]))
        del self.layers[shared + 1 :], self.ways[shared:]
        for symbol in signature[shared:]:
            layer, spent = self.layers[-1]
            found = self.steps.get((layer, symbol))
            if found is None:
                found = self.steps[layer, symbol] = _step(layer, symbol)
            self.layers.append((found[0], spent + found[1]))
            self.ways.append(found[2])
            self.computed += 1
        self.word = signature
        layer, spent = self.layers[-1]
        _, _, state = min((known[0] + INSERT * len(self._missing[q]), known[1], q) for q, known in enumerate(layer) if known is not None)
        cost = spent + layer[state][0] + INSERT * len(self._missing[state])
        tokens = [self._missing[state]]
        for way in reversed(self.ways):
            state, token = way[state]
            tokens.append(token)
        self.answered = cost, "".join(reversed(tokens))
        return self.answered


# --- streams over sorted rows


class _Out:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: str, kinds: list[pa.DataType]):
        self.names = [part.split()[0] for part in schema.split(", ")]
        self.kinds, self.rows, self.chars = kinds, [], 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += sum(len(x) for x in row if isinstance(x, str))
        if len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), self.kinds, strict=True)], names=self.names)
            self.rows, self.chars = [], 0


_LONGS = [pa.int64()] * 6


class _Signer:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.seen = conv_id, bytearray(), set()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.last_turn: int | None = None

    def add(self, turn: int | None, initial: str, fault: str, key: bytes) -> None:
        if turn is not None and turn != self.last_turn:  # turns come in order
            self.turns += 1
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault == "blank":
            self.blank += 1
            symbol = "d"
        elif key in self.seen:
            self.duplicate += 1
            symbol = "d"
        else:
            symbol = initial if initial in ("s", "u", "a") else "x"
            if fault == "truncated":
                self.truncated += 1
                symbol = symbol.upper()
        self.seen.add(key)
        self.symbols += symbol.encode()

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.symbols.decode()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, now = _Out(_SIGNED, [*_LONGS, pa.string()]), None
    for batch in batches:
        for conv_id, turn, left, initial, fault, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield from out.add(now.row())
                now = _Signer(conv_id)
            if left:
                now.add(turn, initial, fault, key)
    if now is not None:
        yield from out.add(now.row())
    yield from out.rest()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, out = PrefixTrie(), _Out(_REPAIRED, [*_LONGS, pa.int64(), pa.string()])
    for batch in batches:
        for *told, signature in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield from out.add((*told, *trie.answer(signature)))
    yield from out.rest()


class _Writer:
    def __init__(self, answer: tuple):
        self.answer, self.audit, self.at, self.state = answer, answer[-1], 0, _NOTHING
        self.hash, self.any = hashlib.sha256(), False

    def give(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            role = _next_role(self.state)
            self.give(role, "")
            self.state, self.at = _given(self.state, role[0]), self.at + 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            role = _next_role(self.state) if edit == "R" else role
            self.give(role, text)
            self.state = _given(self.state, role[:1])

    def row(self) -> tuple:
        self.inserts()
        return (*self.answer, self.hash.hexdigest())


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, now = _Out(_FINAL, [*_LONGS, pa.int64(), pa.string(), pa.string()]), None
    for batch in batches:
        for kind, left, role, text, *answer in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                if now is not None:
                    yield from out.add(now.row())
                now = _Writer(tuple(answer))
            elif left:
                now.add(role, text)
    if now is not None:
        yield from out.add(now.row())
    yield from out.rest()


# --- frames


def spaced(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with one space for a null role or text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"))


def damage_code() -> Column:
    """What happens to a row: ``crc32(conv_id:turn) % 20``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20


def _damaged(rows: DataFrame, code: Column | None) -> DataFrame:
    """Apply the damage to rows, whose order it keeps; ``left`` tells which rows are still there."""
    if code is None:
        return rows.withColumn("left", F.lit(True))
    # a row that gets lost stays as a mark, for its conversation is answered all the same
    rows = rows.withColumn("_code", code).withColumn("left", F.col("_code") != 0)
    rows = rows.withColumn("role", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")))
    rows = rows.withColumn("text", F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")))
    return rows.withColumn("_again", F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_code", "_again")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition(parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def signatures(turns: DataFrame, code: Column | None = None) -> DataFrame:
    """Faults and signature of each conversation; ``code`` damages the turns first."""
    rows = _damaged(_in_order(spaced(turns)), code)
    blank = F.translate("text", SPACES, "") == ""
    whole = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1).isin(*ENDS)
    fault = F.when(blank, "blank").when(~whole, "truncated").otherwise("")
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    return rows.select("conv_id", "turn", "left", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), key.alias("key")).mapInArrow(_sign, _SIGNED)


def repairs(signed: DataFrame) -> DataFrame:
    """Cost and audit of each signature, for every conversation."""
    dealt = signed.repartitionByRange(parts(signed.sparkSession), "signature", "conv_id").sortWithinPartitions("signature", "conv_id")
    return dealt.select("conv_id", *_TOLD, "signature").mapInArrow(_walk, _REPAIRED)


def rewritten(turns: DataFrame, repaired: DataFrame, code: Column | None = None) -> DataFrame:
    """``repaired`` with the SHA-256 of each conversation's repaired ``role:text`` lines."""
    told = [*_TOLD, "cost", "audit"]
    rows = spaced(turns).withColumn("kind", F.lit(1))
    for c in told:
        rows = rows.withColumn(c, F.lit(None).cast("string" if c == "audit" else "long"))
    none = F.lit(None)
    heads = repaired.select("conv_id", none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).alias("kind"), *told)
    both = _in_order(rows.unionByName(heads), "kind")
    if code is not None:
        code = F.when(F.col("kind") == 0, -1).otherwise(code)
    return _damaged(both, code).select("kind", "left", "role", "text", "conv_id", *told).mapInArrow(_rewrite, _FINAL)


def repair(turns: DataFrame, code: Column | None = None) -> DataFrame:
    """One row for each conversation: faults, cost, audit and hash of the repaired turns."""
    signed = materialise(signatures(turns, code))
    return rewritten(turns, repairs(signed), code)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"), damage_code())


#: The edits as rows of a recursion, the best way to each state kept at each turn: for small tables.
OP13_SQL = """
WITH RECURSIVE spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS code
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, role AS role0, text AS text0, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS again
  FROM spaced WHERE code <> 0
), placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER w AS place, left(role, 1) AS c, lag(left(role, 1)) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, role0, text0, again) AS seen
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, text0, again)
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM faults GROUP BY 1
), ids AS (SELECT DISTINCT conv_id FROM conversations),
inserts(state, marks, given, spent, now) AS (VALUES (0, '', '', 0, 0), (0, 'I', E'user:\\n', 5, 2), (0, 'II', E'user:\\nassistant:\\n', 10, 3), (1, '', '', 0, 1), (1, 'I', E'user:\\n', 5, 2), (1, 'II', E'user:\\nassistant:\\n', 10, 3), (2, '', '', 0, 2), (2, 'I', E'assistant:\\n', 5, 3), (3, '', '', 0, 3), (3, 'I', E'user:\\n', 5, 2)),
edits(now, edit, c, role, cost, next) AS (VALUES (0, 'D', NULL, NULL, 2, 0), (1, 'D', NULL, NULL, 2, 1), (2, 'D', NULL, NULL, 2, 2), (3, 'D', NULL, NULL, 2, 3), (0, 'K', 's', NULL, 0, 1), (0, 'K', 'u', NULL, 0, 2), (1, 'K', 'u', NULL, 0, 2), (3, 'K', 'u', NULL, 0, 2), (2, 'K', 'a', NULL, 0, 3), (0, 'R', NULL, 'user', 1, 2), (1, 'R', NULL, 'user', 1, 2), (3, 'R', NULL, 'user', 1, 2), (2, 'R', NULL, 'assistant', 1, 3)),
ways AS (
  SELECT conv_id, 0::BIGINT AS place, 0 AS state, 0 AS cost, '' AS audit, '' AS lines FROM ids
  UNION ALL
  SELECT conv_id, place, state, cost, audit, lines FROM (
    SELECT w.conv_id, f.place, e.next AS state, w.cost + i.spent + e.cost + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost, w.audit || i.marks || e.edit AS audit,
      w.lines || i.given || CASE e.edit WHEN 'D' THEN '' ELSE coalesce(e.role, f.role) || ':' || f.text || chr(10) END AS lines
    FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1 JOIN inserts i ON i.state = w.state JOIN edits e ON e.now = i.now
    WHERE (e.edit <> 'K' OR e.c = f.c) AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, place, state ORDER BY cost, audit) = 1
), finals(state, marks, given, spent) AS (VALUES (0, '', '', 0), (1, 'II', E'user:\\nassistant:\\n', 10), (2, 'I', E'assistant:\\n', 5), (3, '', '', 0)),
best AS (
  SELECT w.conv_id, w.cost + f.spent AS cost, w.audit || f.marks AS audit, w.lines || f.given AS lines
  FROM ways w JOIN finals f USING (state) LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.place = coalesce(t.n, 0)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + f.spent, w.audit || f.marks) = 1
)
SELECT b.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate, coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, b.cost::BIGINT AS cost, b.audit, sha256(left(b.lines, greatest(0, length(b.lines) - 1))) AS repaired_sha256
FROM best b LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM b.conv_id
"""
