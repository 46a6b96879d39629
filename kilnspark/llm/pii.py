"""Personal data: fixed base patterns plus spans of a character BiLSTM-CRF.

The network learns from labelled spans that ``training_windows`` writes: personal data in
usual and unusual spellings among filler words, and look-alikes that are none.
Its windows overlap by half.  Where windows overlap, their emissions are averaged, and one
Viterbi pass over a whole region of windows gives the tags, so that overlaps agree on one
sequence.  Only spans that also pass the kind's own check (digits, an at sign and a dot)
are added, where they touch no base span; an address of four numbers that would
pass is a base span already.  That check asks for a digit, an '@', an '(at)' or an
'[at]' inside the span, so regions are laid around these, a window wider on each side, and
grow while a span runs to their edge; text far from any of them can't hold a span that passes.

Defined cases: a null text is an empty one; repeated rows get equal results; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnspark.llm.bilstm_crf import KINDS, TAGS, Model, char_classes
from kilnspark.llm.common import small_batches, table, texts

WINDOW = 64
TRAIN_WINDOWS = 3000
TRAIN_STEPS = 220
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits: the run's first digit would match too
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every span that _valid accepts holds.
_SEED = re.compile(r"[0-9@]|\(at\)|\[at\]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _passes(kind: str, s: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p := q.lstrip("0")) <= 3 and int(p or "0") <= 255 for q in s.split("."))
    d = _digits(s)
    return 12 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at signs in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            if _passes(kind, m[0]):
                found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _join(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


# ---------------------------------------------------------------- training


def _number(rng, n: int) -> str:
    return "".join(str(d) for d in rng.integers(0, 10, n))


def _card(rng) -> str:
    body = _number(rng, 15)
    d = next(c for c in "0123456789" if luhn(body + c))
    s, sep = body + d, str(rng.choice(["", " ", "-", "."]))
    return sep.join(s[i : i + 4] for i in range(0, 16, 4))


def _word(rng, upper: bool = False) -> str:
    w = "".join(rng.choice(["the", "an", "re", "on", "er", "in", "st", "ou", "ha", "li", "é", "ü", "que", "ción"], rng.integers(1, 4)))
    return w.upper() if upper else w


def _plain(rng, n: int) -> str:
    return "".join(chr(97 + c) for c in rng.integers(0, 26, n))


def _sample(rng) -> tuple[str, str | None]:
    """A string and its kind; None for look-alikes."""
    k = rng.integers(0, 9)
    name, host = f"{_plain(rng, rng.integers(2, 8))}{rng.choice(['.', '_', ''])}{_number(rng, rng.integers(0, 3))}", _plain(rng, rng.integers(3, 8))
    if k == 0:
        return f"{name}@{host}.{rng.choice(['com', 'org', 'example.com'])}", "email"
    if k == 1:
        return f"{name} {rng.choice(['@', '(at)', '[at]'])} {host}.{rng.choice(['com', 'org', 'net'])}", "email"
    if k == 2:
        return ".".join(str(x) for x in rng.integers(0, 256, 4)), "ip"
    if k == 3:
        return _card(rng), "card"
    if k in (4, 5):
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        return str(rng.choice([f"+1 ({a}) {b}-{c}", f"+{_number(rng, 2)} {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"])), "phone"
    if k == 6:
        return str(rng.choice([f"{_number(rng, 4)}-{_number(rng, 2)}-{_number(rng, 2)}", f"{_number(rng, 2)}:{_number(rng, 2)}", f"v{_number(rng, 1)}.{_number(rng, 1)}", _number(rng, rng.integers(1, 7))])), None
    if k == 7:
        return "".join(rng.choice(list("0123456789abcdef"), 28)), None
    return f"@{_plain(rng, 6)}", None


def training_windows(count: int = TRAIN_WINDOWS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows: classes and tags of ``count`` windows of WINDOW characters."""
    rng = np.random.default_rng(seed)
    x, y = np.empty((count, WINDOW), dtype=np.int64), np.zeros((count, WINDOW), dtype=np.int64)
    for k in range(count):
        text, spans = "", []
        while len(text) < 2 * WINDOW:
            text += _word(rng) + rng.choice([" ", " ", " ", ", ", ".\n"])
            if rng.random() < 0.25:
                s, kind = _sample(rng)
                if kind:
                    spans.append((len(text), len(text) + len(s), kind))
                text += s + rng.choice([" ", ". ", ",\n"])
        at = int(rng.integers(0, WINDOW))
        x[k] = char_classes(text[at : at + WINDOW])
        tags = np.zeros(len(text), dtype=np.int64)
        for a, b, kind in spans:
            t = 1 + 2 * KINDS.index(kind)
            tags[a:b], tags[a] = t + 1, t
        y[k] = tags[at : at + WINDOW]
    return x, y


_trained: dict[tuple[int, int], Model] = {}


def trained(windows: int = TRAIN_WINDOWS, steps: int = TRAIN_STEPS) -> Model:
    """The fitted model; fitted once in each process."""
    if (windows, steps) not in _trained:
        model = Model()
        model.fit(*training_windows(windows), steps=steps)
        _trained[windows, steps] = model
    return _trained[windows, steps]


# ---------------------------------------------------------------- decoding


STEP = WINDOW // 2
#: Windows of a region that one Viterbi pass takes; longer regions are cut, with two windows in common.
REGION = 128


def _last(n: int) -> int:
    """Number of the last window of a text of ``n`` characters."""
    return max(0, -(-(n - WINDOW) // STEP))


def _regions(text: str) -> list[tuple[int, int]]:
    """First and last window of each region: windows with a seed in their middle, and one more on each side."""
    last = _last(len(text))
    seeded = sorted({min(last, max(0, (m.start() - STEP // 2) // STEP)) for m in _SEED.finditer(text)})
    return _joined([(max(0, k - 1), min(last, k + 1)) for k in seeded])


def _joined(regions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(regions):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pieces(a: int, b: int) -> list[tuple[int, int, int, int]]:
    """Passes over a region: first and last window, and the characters that each pass owns (from the region's text offset)."""
    out, at = [], a
    while True:
        end = min(b, at + REGION - 1)
        own_from = at * STEP if at == a else at * STEP + WINDOW // 2
        out.append((at, end, own_from, end * STEP + WINDOW if end == b else (end - 1) * STEP + WINDOW // 2))
        if end == b:
            return out
        at = end - 1


def _valid(kind: str, s: str) -> bool:
    """The kind's own check on a span of the network."""
    d = _digits(s)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?(@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s))
    if kind == "ip":
        return False  # every valid address is a base span already
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d) and bool(re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", s))
    return 9 <= len(d) <= 15 and bool(re.fullmatch(r"\+?\(?[0-9][ ().0-9-]*[0-9]", s)) and bool(re.search(r"[^0-9]", s))


#: Numbers of windows that passes are filled up to, so that those of like size go together.
_SIZES = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128])


def _tags(docs: list[str], passes: list[tuple[int, int, int]], model: Model) -> list[np.ndarray]:
    """Tags of each pass (document, first and last window): averaged emissions, one Viterbi.

    Behind a pass that is shorter than others of its size nothing but the outside tag is possible.
    """
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(passes)
    count = np.array([b - a + 1 for _, a, b in passes])
    size_of = _SIZES[np.searchsorted(_SIZES, count)]
    for m in np.unique(size_of).tolist():
        members = np.flatnonzero(size_of == m)
        size = (m - 1) * STEP + WINDOW
        most = max(1, 3072 // m)
        for cut in range(0, len(members), most):
            part = members[cut : cut + most]
            whole = np.full((len(part), size), 4, dtype=np.int64)
            for r, i in enumerate(part.tolist()):
                d, a, b = passes[i]
                c = char_classes(docs[d][a * STEP : b * STEP + WINDOW])
                whole[r, : len(c)] = c
            windows = [(np.flatnonzero(count[part] > w), w) for w in range(m)]
            e = model.emissions(np.concatenate([whole[rows, w * STEP : w * STEP + WINDOW] for rows, w in windows]))[0]
            total, seen, at = np.zeros((size, len(part), TAGS)), np.zeros((size, len(part)), dtype=np.int64), 0
            for rows, w in windows:
                total[w * STEP : w * STEP + WINDOW, rows] += e[:, at : at + len(rows)]
                seen[w * STEP : w * STEP + WINDOW, rows] += 1
                at += len(rows)
            total /= np.maximum(seen, 1)[:, :, None]
            total[:, :, 1:][seen == 0] = -1e6
            found = model.viterbi(total).astype(np.int8)
            for r, i in enumerate(part.tolist()):
                out[i] = found[r, : (count[i] - 1) * STEP + WINDOW]
    return out


def model_spans(docs: list[str], model: Model) -> list[list[tuple[int, int, str]]]:
    """Spans of the network in each text, from one tag sequence for each region."""
    regions = [_regions(text) for text in docs]
    tags: list[dict[tuple[int, int], np.ndarray]] = [{} for _ in docs]
    while True:
        todo = [(d, r) for d, rs in enumerate(regions) for r in rs if r not in tags[d]]
        if not todo:
            break
        passes = [(d, p, r) for d, r in todo for p in _pieces(*r)]
        found = _tags(docs, [(d, p[0], p[1]) for d, p, _ in passes], model)
        joined: dict[tuple[int, tuple[int, int]], list[np.ndarray]] = {}
        for (d, (a, _, own_from, own_to), r), t in zip(passes, found):
            joined.setdefault((d, r), []).append(t[own_from - a * STEP : own_to - a * STEP])
        for (d, r), parts in joined.items():
            tags[d][r] = np.concatenate(parts)[: max(0, len(docs[d]) - r[0] * STEP)]
        grown = set()
        for d, r in todo:
            t, last = tags[d][r], _last(len(docs[d]))
            more = r[1] - r[0] + 1  # by as much again, so that a long run is read a few times only
            a = max(0, r[0] - more) if len(t) and t[0] else r[0]
            b = min(last, r[1] + more) if len(t) and t[-1] else r[1]
            if (a, b) != r:
                regions[d] = [(a, b) if x == r else x for x in regions[d]]
                grown.add(d)
        for d in grown:
            regions[d] = _joined(regions[d])
    return [_good(text, [(r[0] * STEP, tags[d][r]) for r in regions[d]]) for d, text in enumerate(docs)]


def _good(text: str, parts: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, str]]:
    """Spans of tagged parts, trimmed, at word bounds and accepted by the kind's check."""
    spans: list[tuple[int, int, str]] = []
    for offset, t in parts:
        start, kind, last = None, None, None
        for p in np.flatnonzero(t).tolist():
            tag = int(t[p])
            mine = KINDS[(tag - 1) // 2]
            if start is not None and (mine != kind or tag % 2 == 1 or p != last + 1):
                spans.append((offset + start, offset + last + 1, kind))
                start = None
            if start is None:
                start, kind = p, mine
            last = p
        if start is not None:
            spans.append((offset + start, offset + last + 1, kind))
    good = []
    for a, b, kind in spans:
        while a < b and text[a] in " \n,":
            a += 1
        while b > a and text[b - 1] in " \n,.":
            b -= 1
        bounded = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())
        if bounded and _valid(kind, text[a:b]):
            good.append((a, b, kind))
    return good


def find_spans(docs: list[str], model: Model) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    out = []
    for text, more in zip(docs, model_spans(docs, model)):
        base = base_spans(text)
        added = [s for s in more if not any(s[0] < b and a < s[1] for a, b, _ in base)]
        out.append((base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def _run(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            rows = []
            docs = [t.decode() for t in texts(batch.column("text"))]
            for doc, (base, all_) in zip(batch.column("doc_id").to_pylist(), find_spans(docs, model)):
                n = [sum(s[2] == k for s in base) for k in KINDS]
                rows.append((doc, *n, hashlib.sha256(_join(base).encode()).hexdigest(), _join(all_), len(all_)))
            cols = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, all spans and their number; one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_run(model or trained()), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
