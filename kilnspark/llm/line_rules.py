"""Line rules: cross-document line frequency (quality) and site-relative frequency (line dedup).

The host of a document is its ``source`` (null: the empty host).  A line is a
``\\n``-separated part with at least one word; lines are compared after
lower-casing A-Z and joining their words by one space.  A page that repeats
another page of its host word for word is one page, so that groups of exact
copies do not turn their own lines into boilerplate; near-duplicate removal
deals with those.  A line that fewer than ``min_pages`` pages hold is never too
frequent: by default two, since a line of one page is no repeat at all, while on a
host of few pages the ratio alone would say that of every line.

Lines above a limit are at most 1 / ``max_ratio`` times a host's lines on a mean page,
so a host's set of them is as small as a page.  Sets meet the documents by
broadcast behind a count of their lines (``BROADCAST_LINES``), beyond it by a salted join; texts are not
shuffled but beyond it.

Defined cases: null texts stay null and count as empty; rows without an id are documents as others;
repeated rows get equal results; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kilnspark.llm.common import materialise, small_batches, table, texts
from kilnspark.llm.kernels import _LOWER, as_bytes, mix, powers, word_bounds, word_hashes

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_BLANKS = b" \t\r\x0b\x0c"


def repeated_words(words: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    if len(words) < 4:
        return 0
    grams = mix(mix(mix(words[:-2]) + words[1:-1]) + words[2:])
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    twice = np.zeros(len(grams), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words), dtype=bool)
    for j in range(3):
        cover[j : j + len(grams)] |= twice
    return int(cover.sum())


def _line_table(text: bytes, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and number of words of each line with a word; repeated exact lines."""
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
    line_of = np.searchsorted(np.flatnonzero(data == 10), starts)
    first = np.flatnonzero(np.concatenate(([True], line_of[1:] != line_of[:-1])))
    counts = np.diff(np.append(first, len(starts)))
    words = word_hashes(_LOWER[data])
    _, down = powers(len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * down, out=sums[1:])
    up, _ = powers(len(words))
    hashes = mix((sums[first + counts] - sums[first]) * up[first] + counts.astype(np.uint64))
    seen, repeats = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.strip(_BLANKS):
            seen.add(line)
    return hashes.view(np.int64), counts, repeats


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        cols: list[list] = [[] for _ in range(8)]
        for text in texts(batch.column("text")):
            data = as_bytes(text)
            words = word_hashes(data)
            hashes, counts, repeats = _line_table(text, data)
            starts, ends = word_bounds(data)
            code_points = int(((data & 0xC0) != 0x80).sum()) - (len(data) - int((ends - starts).sum()))
            distinct, where = np.unique(hashes, return_inverse=True)
            for col, value in zip(cols, (len(words), code_points, int(_SYMBOLS[data].sum()), repeats, repeated_words(words), int(np.add.reduce(mix(hashes.view(np.uint64) * np.arange(1, 2 * len(hashes) + 1, 2, dtype=np.uint64))).view(np.int64)) if len(hashes) else 0, distinct, np.bincount(where, weights=counts, minlength=len(distinct)).astype(np.int64))):
                col.append(value)
        longs = pa.list_(pa.int64())
        arrays = [pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(c, longs) for c in cols[6:]]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), batch.column("text_hash"), *arrays], names=["doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "page", "lines", "line_words"])


_MEASURED = "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, page long, lines array<long>, line_words array<long>"
#: Lines above the limits, over all hosts, up to which their sets are broadcast (8 bytes a line).
BROADCAST_LINES = 1_000_000
SALTS = 16


def _rest(names: list[str], text_col: str) -> Column:
    """All columns but the text, in one."""
    return F.struct(*[F.col(f"`{c}`") for c in names if c != text_col], F.lit(0).alias("_"))


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit(""))


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _host(host_col).alias("host"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return materialise(rows.mapInArrow(_measure, _MEASURED))


def _frequent(pages: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, line) above the limits, from the distinct (host, page, lines)."""
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_pages"))
    over = counts.where(F.col("n_pages") >= min_pages).join(totals, "host")
    return materialise(over.where(F.col("n_pages") > max_ratio * F.col("pages")).select("host", "line"))


def _with_sets(rows: DataFrame, over: DataFrame, host: str, spread: list[Column], name: str) -> DataFrame:
    """``rows`` with the array of their host's lines above the limits (null: none) as ``name``."""
    sets = over.groupBy(F.col("host").alias(host)).agg(F.collect_set("line").alias(name))
    if over.count() <= BROADCAST_LINES:
        return rows.join(F.broadcast(sets), host, "left")
    salt = f"{name}_salt"
    salted = sets.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).join(salted, [host, salt], "left").drop(salt)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_ratio: float = 0.1, min_pages: int = 2, min_left: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: base measures, ``n_removed_words`` and ``kept``.

    Lines on more than ``max_ratio`` of a host's distinct pages, and on
    ``min_pages`` at least, are removed; a document that keeps less than
    ``min_left`` of its words is depleted and rejected, as is one that fails
    the base rules.  ``clean`` returns the documents themselves.
    """
    measured = _measured(docs, id_col, text_col, host_col)
    over = _frequent(measured.select("host", "page", "lines").dropDuplicates(["host", "page"]), max_ratio, min_pages)
    joined = _with_sets(measured, over, "host", [F.col("text_hash"), F.col("doc_id")], "gone")
    lost = F.expr("aggregate(filter(arrays_zip(lines, line_words), x -> array_contains(gone, x.lines)), 0L, (n, x) -> n + x.line_words)")
    removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(lost).cast("long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = joined.withColumn("n_removed_words", removed)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_removed_words",
        (~failed & (F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words"))).alias("kept"),
    )


def cut_lines(text: bytes, gone: np.ndarray, min_left: float) -> bytes | None:
    """The text without the lines of ``gone``; None if it fails the base rules or is depleted."""
    data = as_bytes(text)
    words = word_hashes(data)
    if len(words) < 50 or 100 * repeated_words(words) > 50 * len(words):
        return None
    hashes, counts, _ = _line_table(text, data)
    drop = np.isin(hashes, gone)
    if not drop.any():
        return text
    if len(words) - counts[drop].sum() < min_left * len(words):
        return None
    lines = text.split(b"\n")
    filled = [k for k, line in enumerate(lines) if line.strip(_BLANKS)]
    bad = {filled[k] for k in np.flatnonzero(drop).tolist()}
    return b"\n".join(line for k, line in enumerate(lines) if k not in bad)


def _apply(min_left: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            none = np.zeros(0, dtype=np.int64)
            left = [cut_lines(t, none if g is None else np.array(g, dtype=np.int64), min_left) for t, g in zip(texts(batch.column("text")), batch.column("gone").to_pylist())]
            at = [k for k, t in enumerate(left) if t is not None]
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([left[k].decode() for k in at], pa.string()), kept.column("rest")], names=["text", "rest"])

    return run


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_ratio: float = 0.1, min_pages: int = 2, min_left: float = 0.3) -> DataFrame:
    """The documents that ``quality`` keeps, without the lines above its limits; columns stay."""
    pages = _measured(docs, "doc_id", text_col, host_col).select("host", "page", "lines").dropDuplicates(["host", "page"])
    over = _frequent(pages, max_ratio, min_pages)
    names = docs.columns
    rows = docs.select(F.col(text_col).cast("string").alias("text"), _host(host_col).alias("host"), _rest(names, text_col).alias("rest"))
    joined = _with_sets(rows, over, "host", [F.col("text"), F.col("rest")], "gone").select("text", "gone", "rest")
    schema = StructType([StructField("text", StringType()), StructField("rest", joined.schema["rest"].dataType)])
    done = joined.mapInArrow(_apply(min_left), schema)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in names])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go (null and empty texts with them), the others lose the lines above the limits.

    Rows without an id and repeated rows are judged each by its text; an empty table stays empty.
    """
    return clean(docs)


def _lines(text: Column) -> Column:
    """The lines of a text with words in lower case (A-Z), one space between them and at most one at each end."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(lowered, r"[\x20\x09\x0B-\x0D]+", " "), "\n")


def line_dedup(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text_col``; rows and columns stay.

    A line is boilerplate when more than ``max_ratio`` of the host's distinct
    pages, and ``min_pages`` at least, contain it, whatever share of a page
    such lines take; a page of nothing else becomes an empty text.
    """
    filled = F.filter(F.transform(_lines(F.col(text_col)), lambda k: F.trim(k)), lambda k: k != "")
    pages = docs.select(_host(host_col).alias("host"), F.xxhash64(text_col).alias("page"), F.array_distinct(F.transform(filled, lambda k: F.xxhash64(k))).alias("lines"))
    seen = materialise(pages.where(F.col("lines").isNotNull()).dropDuplicates(["host", "page"]))
    over = _frequent(seen, max_ratio, min_pages)

    names = docs.columns
    rows = docs.select(F.col(text_col).alias("text"), _host(host_col).alias("host"), _rest(names, text_col).alias("rest"))
    joined = _with_sets(rows, over, "host", [F.col("text"), F.col("rest")], "gone")
    both = F.arrays_zip(F.split("text", "\n").alias("line"), _lines(F.col("text")).alias("key"))
    left = F.filter(both, lambda x: ~F.array_contains(F.col("gone"), F.xxhash64(F.trim(x.key))))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda x: x.line), "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in names])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: boilerplate lines go, every document stays, null texts and repeated rows included."""
    return line_dedup(docs)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup(docs).select("doc_id", F.length("text").cast("long").alias("n_chars_left"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


#: DuckDB SQL for op8_line_dedup.
OP8_SQL = r"""
WITH pages AS (
  SELECT doc_id, text, coalesce(source, '') AS host, md5(text) AS page, string_split(text, chr(10)) AS parts FROM documents
), keyed AS (
  SELECT host, page, list_distinct(list_filter(list_transform(parts,
    lambda x: trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), lambda k: k <> '')) AS keys
  FROM pages
), seen AS (SELECT DISTINCT host, page, unnest(keys) AS line FROM keyed),
totals AS (SELECT host, count(DISTINCT page) AS n FROM pages WHERE text IS NOT NULL GROUP BY host),
over AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS c FROM seen GROUP BY host, line) JOIN totals USING (host)
  WHERE c >= 2 AND c > 0.1 * n
), dropped AS (SELECT host, page, list(line) AS gone FROM seen JOIN over USING (host, line) GROUP BY host, page),
cut AS (
  SELECT p.doc_id, p.text, d.gone, array_to_string(list_filter(p.parts,
    lambda x: NOT list_contains(d.gone, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '))), chr(10)) AS short
  FROM pages p LEFT JOIN dropped d ON p.host = d.host AND p.page = d.page
), done AS (
  SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE short END AS text FROM cut
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars_left, md5(coalesce(text, '')) AS text_md5 FROM done
"""
