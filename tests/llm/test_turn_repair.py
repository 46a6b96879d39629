"""Conversation repair against plain recursion over single edits."""

import hashlib
import itertools
import random
import zlib
from functools import cache

import pytest

from kilnspark.llm import turn_repair

DATA = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(symbols):
    """(cost, audit) by recursion from the end, one edit at a time; the whole strings are compared."""

    @cache
    def go(at, given, inserted):
        # given: "" nothing, else the last role's initial
        found = []
        if at == len(symbols) and given in ("", "a"):
            found.append((0, ""))
        follows = {"": "u", "s": "u", "u": "a", "a": "u"}[given]
        if inserted < 3:
            cost, rest = go(at, follows, inserted + 1)
            found.append((cost + 5, "I" + rest))
        if at < len(symbols):
            c = symbols[at]
            cost, rest = go(at + 1, given, 0)
            found.append((cost + 2, "D" + rest))
            if c != "d":
                extra = 5 if c.isupper() else 0
                if c.lower() == follows or (c.lower() == "s" and given == ""):
                    cost, rest = go(at + 1, c.lower(), 0)
                    found.append((cost + extra, "K" + rest))
                cost, rest = go(at + 1, follows, 0)
                found.append((cost + extra + 1, "R" + rest))
        return min(found, default=(10**9, ""))

    return go(0, "", 0)


def test_all_short_signatures():
    trie = turn_repair.PrefixTrie()
    words = sorted("".join(w) for n in range(5) for w in itertools.product("dsuaxSUAX", repeat=n))
    for w in words:
        assert trie.answer(w) == cheapest(w), w
    # a layer for each node of the trie, not for each symbol of each word
    assert trie.computed == len(words) - 1


def test_long_signatures():
    rng = random.Random(5)
    trie = turn_repair.PrefixTrie()
    for w in sorted("".join(rng.choice("dsuaxUA" if k % 2 else "uaua" "UAd") for _ in range(rng.randrange(60))) for k in range(400)):
        assert trie.answer(w) == cheapest(w), w
    assert len(trie.steps) < 1000


def test_very_long_signature():
    trie = turn_repair.PrefixTrie()
    cost, audit = trie.answer("ua" * 100_000)
    assert cost == 0 and audit == "K" * 200_000
    assert trie.answer("ua" * 100_000 + "U")[1].startswith("K" * 200_000)


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        left = []
        for turn, role, text in turns:
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if code == 0:
                continue
            text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
            left += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        nums = [t for t, _, _ in left if t is not None]
        gaps = max(nums) - min(nums) + 1 - len(set(nums)) if nums else 0
        symbols, seen, blank, dup, cut = "", set(), 0, 0, 0
        for _, role, text in left:
            solid = text.rstrip(SPACES)
            if not solid:
                blank += 1
                symbols += "d"
            elif (role, text) in seen:
                dup += 1
                symbols += "d"
            else:
                c = role[:1] if role[:1] in ("s", "u", "a") else "x"
                if solid[-1] not in ".!?":
                    cut += 1
                    c = c.upper()
                symbols += c
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(left))
        cost, audit = cheapest(symbols)
        given, lines, rest = "", [], iter(left)
        for e in audit:
            follows = {"": "user", "s": "user", "u": "assistant", "a": "user"}[given]
            if e == "I":
                lines.append((follows, ""))
            else:
                _, role, text = next(rest)
                if e == "D":
                    continue
                lines.append((role if e == "K" else follows, text))
            given = lines[-1][0][:1]
        assert "".join(r[:1] for r, _ in lines).removeprefix("s").replace("ua", "") == ""
        out[conv] = (gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def answers(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def fixture():
    rng = random.Random(3)
    rows = []
    for conv in range(160):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn * rng.choice([1, 1, 3]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["Hi.", "Well", "Yes! ", "", None, " \n", "Who?\t", f"No {turn}."])))
    rows += [(500, None, "user", "A."), (500, None, "user", "A."), (500, 2, "assistant", "B."), (None, 0, "user", "x."), (None, None, None, None), (-7, -3, "user", " "), (-7, -3, "assistant", "é!　")]
    rows += [(501, t, "user" if t % 2 == 0 else "assistant", f"{t}." * 50) for t in range(200)]
    return rows


def test_rows_against_recursion(spark):
    rows = fixture()
    assert answers(turn_repair.repair(frame(spark, rows), turn_repair.damage_code())) == expected(rows)


def test_order_of_rows_does_not_matter(spark):
    rows = fixture()
    want = expected(rows)
    random.Random(1).shuffle(rows)
    assert answers(turn_repair.repair(frame(spark, rows).repartition(7), turn_repair.damage_code())) == want


def test_without_damage_nothing_is_lost(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 0, "assistant", "Hi."), (2, 1, "user", "Go")]
    found = answers(turn_repair.repair(frame(spark, rows)))
    assert found[1][5:7] == (0, "KKK")
    assert found[2][5:7] == cheapest("aU")


def test_empty_table_and_clashing_columns(spark):
    assert turn_repair.repair(frame(spark, []), turn_repair.damage_code()).collect() == []
    rows = fixture()[:40]
    more = frame(spark, rows).selectExpr("*", "text AS signature", "turn AS kind", "role AS audit", "1 AS cost", "false AS left")
    assert answers(turn_repair.repair(more, turn_repair.damage_code())) == expected(rows)


@pytest.mark.skipif(not __import__("os").path.isdir(DATA), reason="the driver's tables are not here")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answers(turn_repair.op13_turn_repair(spark, DATA)) == expected(rows)
