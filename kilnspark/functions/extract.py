"""Answer extraction from model responses, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """First match or null."""
    hit = F.regexp_extract(text, pattern, group)
    return F.when(hit != "", hit)


def last(text: Column, pattern: str, group: int = 0) -> Column:
    """Last match or null."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))


def bottom_up(text: Column, pattern: str) -> Column:
    """Last match of the last line that has one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(pattern))
    return last(F.try_element_at(lines, F.lit(-1)), pattern)


def ids(text: Column, pattern: str) -> Column:
    """Distinct upper-cased identifiers in order of appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.upper))


def choice(text: Column) -> Column:
    """``answer is (X)``, then ``Answer: X``, then the last lone letter, then NOT_FOUND."""
    return F.coalesce(found(text, r"(?i)answer is \(?([A-J])\)?", 1), found(text, r"(?i)answer:\s*([A-J])", 1), last(text, r"\b([A-J])\b", 1), F.lit("NOT_FOUND"))


def instruction_parts(text: Column) -> Column:
    """Instruction, question and answer sections as a struct."""
    pattern = r"(?s)Instruction: (.*?)\n\s*Question: (.*?)\n\s*Answer: (.*)\s*"
    return F.struct(*[F.regexp_extract(text, pattern, k + 1).alias(n) for k, n in enumerate(("instruction", "input", "output"))])


#: Stand-ins for brackets in templates.
SENTINELS = {"<OBR>": "{", "<CBR>": "}", "<OBK>": "[", "<CBK>": "]"}


def unescape(text: Column) -> Column:
    for mark, sign in SENTINELS.items():
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return text


def collapse_prefixes(text: Column) -> Column:
    """``CVE-CVE-`` and the like lose the doubled prefix."""
    return F.regexp_replace(text, r"\b(CVE|CWE|CAPEC)-(?:\1-)+", "$1-")


def cut_at(text: Column, marks: list[str]) -> Column:
    """The text before the first of the marks, right-trimmed."""
    for m in marks:
        text = F.substring_index(text, m, 1)
    return F.rtrim(text)


def letters(text: Column) -> Column:
    """Sorted distinct answer letters A-H of a JSON list."""
    body = found(text, r"(?s)\[([^\]]*)\]", 1)
    return F.sort_array(F.array_distinct(F.regexp_extract_all(body, F.lit('"([A-H])"'), F.lit(1))))


def first_sentence(text: Column, most: int = 400) -> Column:
    flat = F.trim(F.regexp_replace(text, r"\n+", " "))
    return F.substring(F.get(F.split(flat, r"(?<=[.!?])\s+"), F.lit(0)), 1, most)


def clean_freeform(text: Column) -> Column:
    """Tags out, runs of blank lines to one, ends trimmed."""
    bare = F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), r"\n[ \t]*\n[ \t\n]*", "\n\n")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no fragment, no trailing slash."""
    bare = F.regexp_replace(url, "#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z]+://[^/?]*)", 1))
    rest = F.regexp_replace(bare, r"^[A-Za-z]+://[^/?]*", "")
    return F.concat(head, F.regexp_replace(rest, "/+$", ""))


def safe_name(url: Column, most: int = 80) -> Column:
    """Last path segment with safe characters; long names end in a hash."""
    name = F.regexp_replace(F.try_element_at(F.split(F.regexp_replace(url, r"[/?#]+$", ""), "/"), F.lit(-1)), "[^A-Za-z0-9._-]", "_")
    return F.when(F.length(name) > most, F.concat(F.substring(name, 1, most - 9), F.lit("-"), F.substring(F.sha1(url), 1, 8))).otherwise(name)


def strip_thought(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<think>.*?</think>\s*", "")


def html_text(html: Column) -> Column:
    """Visible text of a page: no scripts, styles or tags; five entities decoded; white space squashed."""
    text = F.regexp_replace(html, r"(?is)<(script|style|nav|header|footer)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", " "), "<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def uuid5(namespace: bytes, name: Column) -> Column:
    """Version-5 UUID of a name in a namespace, from SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex())), name.cast("binary")))
    digit = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), digit % 4 + 1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
