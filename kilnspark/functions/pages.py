"""Content of web pages: main part, sections, labelled values, tables, and markdown from them."""

from __future__ import annotations

from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements without an end tag, elements that hold no text, and navigation.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
NAVIGATION = frozenset(("nav", "header", "footer", "aside"))
_HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
_BREAKS = frozenset("p div li ul ol tr table section article br h1 h2 h3 h4 h5 h6 dd dt dl blockquote pre".split())
PAGE = "title string, text string, sections array<struct<heading:string,body:string>>, labels map<string,string>, rows array<array<string>>"


class _Reader(HTMLParser):
    """One pass over a page; ``main`` names the element, class (.x) or id (#x) that holds the content."""

    def __init__(self, main: str | None, skip: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.main, self.skip = main, skip
        self.open: list[str] = []
        self.inside = 0 if main else 1  # depth below the main element; without one all counts
        self.mute = 0
        self.found = main is None
        self.title, self.text = "", []
        self.sections: list[list] = []
        self.heading: str | None = None
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def _is_main(self, tag: str, attrs: dict) -> bool:
        m = self.main or ""
        if m.startswith("."):
            return m[1:] in (attrs.get("class") or "").split()
        return attrs.get("id") == m[1:] if m.startswith("#") else tag == m

    def handle_starttag(self, tag, attrs):
        if tag in _BREAKS:
            self._put("\n")
        if tag in VOID:
            return
        attrs = dict(attrs)
        self.open.append(tag)
        if self.main and not self.inside and not self.found and self._is_main(tag, attrs):
            self.inside, self.found = len(self.open), True
        if tag in SILENT or tag in self.skip:
            self.mute += 1
        if self.mute or not self.inside:
            return
        if tag in _HEADINGS:
            self.heading = ""
        elif tag == "tr":
            self._close_cell()
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self._close_cell()
            self._put(" ")
            self.cell = []

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open:
            last = self.open.pop()
            if last in SILENT or last in self.skip:
                self.mute -= 1
            elif not self.mute and self.inside:
                if last in _HEADINGS and self.heading is not None:
                    name = " ".join(self.heading.split())
                    self.sections.append([name, []])
                    if last == "h1" and not self.title:
                        self.title = name
                    self.heading = None
                elif last in ("td", "th", "table"):
                    self._close_cell()
            if self.main and self.inside > len(self.open):
                self.inside = 0
            if last == tag:
                break
        if tag in _BREAKS:
            self._put("\n")

    def _close_cell(self):
        """Cells may lack their end tag."""
        if self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def _put(self, data: str):
        if self.mute or not self.inside or "title" in self.open:
            return
        if self.heading is not None:
            self.heading += data
        elif self.sections:
            self.sections[-1][1].append(data)
        if self.cell is not None:
            self.cell.append(data)
        self.text.append(data)

    def handle_data(self, data):
        self._put(" ".join(data.splitlines()) if "pre" not in self.open else data)


def _tidy(parts: list[str]) -> str:
    return "\n".join(x for x in (" ".join(line.split()) for line in "".join(parts).split("\n")) if x)


def read_page(html: str, selectors: tuple[str, ...] = (), skip: frozenset[str] = NAVIGATION) -> dict:
    """Title, text, sections, ``label: value`` lines and table rows of the first selector that the page has, else of the whole page."""
    for main in (*selectors, None):
        reader = _Reader(main, skip)
        reader.feed(html)
        reader.close()
        if reader.found:
            break
    text = _tidy(reader.text)
    labels: dict[str, str] = {}
    for line in text.split("\n"):
        name, colon, value = line.partition(":")
        if colon and 0 < len(name) <= 40 and value.strip():
            labels.setdefault(name.strip(), value.strip())
    return {"title": reader.title, "text": text, "sections": [{"heading": h, "body": _tidy(b)} for h, b in reader.sections], "labels": labels, "rows": [r for r in reader.rows if r]}


def page_parts(html: Column, selectors: tuple[str, ...] = (), skip: frozenset[str] = NAVIGATION) -> Column:
    """Struct of ``title``, ``text``, ``sections``, ``labels`` and ``rows``; null pages are empty."""

    @F.pandas_udf(PAGE)
    def parts(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(p or "", selectors, skip) for p in pages], columns=["title", "text", "sections", "labels", "rows"])

    return parts(html)


#: Entities that a heading's text may hold, in the order in which they are decoded.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}


def first_heading(html: Column, entities: dict[str, str] = ENTITIES) -> Column:
    """What stands in the first bare ``h1`` as it is written, the entities decoded and white space squashed; empty without one."""
    text = F.regexp_extract(html, r"(?s)<h1>(.*?)</h1>", 1)
    for entity, sign in entities.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    # spaces of all kinds go from the ends, other white space has become a space
    return F.regexp_replace(F.regexp_replace(text, r"[ \t\n\f\r]+", " "), r"^\p{Zs}+|\p{Zs}+\z", "")


def trim_lines(text: Column, start: str | None = None, prefixes: tuple[str, ...] = (), lines: tuple[str, ...] = ()) -> Column:
    """Lines from the first that matches ``start`` on (all if none does), without those of the prefixes and the lines given."""
    rows = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    if start is not None:
        flags = F.transform(rows, lambda x: x.rlike(start))
        rows = F.slice(rows, F.greatest(F.array_position(flags, F.lit(True)).cast("int"), F.lit(1)), F.greatest(F.size(rows), F.lit(1)))

    def bad(x: Column) -> Column:
        return reduce(lambda a, b: a | b, [x.startswith(p) for p in prefixes], x.isin(*lines) if lines else F.lit(False))

    return F.array_join(F.filter(rows, lambda x: ~bad(x)), "\n")


def markdown(title: Column, sections: Column) -> Column:
    """``# title``, then ``## heading`` and body of each section that has a body."""
    filled = F.filter(sections, lambda s: F.trim(s["body"]) != "")
    parts = F.transform(filled, lambda s: F.concat(F.lit("## "), F.trim(s["heading"]), F.lit("\n"), F.trim(s["body"]), F.lit("\n")))
    head = F.when(F.coalesce(title, F.lit("")) == "", "#").otherwise(F.concat(F.lit("# "), F.trim(title)))
    return F.concat(F.regexp_replace(F.array_join(F.concat(F.array(head), parts), "\n"), r"^\s+|\s+$", ""), F.lit("\n"))


def headed_name(title: Column) -> Column:
    """Id and name of a page whose title is ``name | id`` or ``id | name`` or starts with an id: struct of ``id`` and ``name``."""
    ident = F.regexp_extract(title, r"\b((?:CWE|CAPEC|CVE)-\d[\d-]*|[TSMG]\d{4}(?:\.\d{3})?)\b", 1)
    rest = F.trim(F.regexp_replace(F.regexp_replace(title, r"\b((?:CWE|CAPEC|CVE)-\d[\d-]*|[TSMG]\d{4}(?:\.\d{3})?)\b", ""), r"^[\s|:-]+|[\s|:-]+$", ""))
    return F.struct(F.when(ident != "", ident).alias("id"), rest.alias("name"))
