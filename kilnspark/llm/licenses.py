"""License scan with DataFrame functions only.

Texts and templates become lower-case ASCII alphanumeric words; everything
else separates them.  MinHash runs over overlapping windows: the universe is
the shingles of the templates, so a window's signature is that of its template
shingles, whatever text surrounds them.  Windows are twice as long as the
longest template and overlap by half, so each occurrence lies whole in one of
them.  With 32 bands of one row, a window that shares a fraction J of its
template shingles with a template is retrieved with probability
1 - (1 - J)**32: above 0.9999 for J >= 0.25.  A template too short to hold that
share of a full window is also retrieved by its shingles themselves: whatever
holds ``containment`` of n shingles holds one of the n - ceil(containment * n) + 1
that the fewest templates have, so none is missed, however many notices stand
together.  Exact containment of the template's shingles in the window then decides.

The template table is a parameter; its shingles are broadcast in blocks of about
``MAX_SHINGLES``, one scan for each block.  Defined cases: null and empty texts have no licenses; rows
that share an id, or have none, are told apart by their texts; rows with equal id and text
answer once; an empty table has no rows; templates with fewer words than a shingle are refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnspark.llm.common import table

#: Short notices of well-known licenses.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
WIDTH = 5
BANDS = 32
#: The bands alone retrieve templates that hold this share of a window's template shingles.
SAFE_SHARE = 0.25
CONTAINMENT = 0.8
#: Shingles of templates that one scan broadcasts (8 bytes each).
MAX_SHINGLES = 1_000_000


def _words(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(lowered, "[^a-z0-9]+", " "), " "), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """xxhash64 of each run of ``width`` words, in order."""
    at = lambda i, j: F.get(words, i + j)
    return F.when(F.size(words) >= width, F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[at(i, j) for j in range(width)])))


def _signature(shingles: Column, bands: int) -> Column:
    """(band, least hash) of each band of one row."""
    hashed = lambda b: lambda x: F.xxhash64(x, F.lit(b))
    return F.array(*[F.struct(F.lit(b).alias("band"), F.array_min(F.transform(shingles, hashed(b))).alias("least")) for b in range(bands)])


def _rare(known: DataFrame, most: int, containment: float) -> DataFrame:
    """Band -1: the shingles by which templates too short for windows of ``most`` shingles are retrieved."""
    n = F.size("ts")
    each = known.select("license", "t", "ts", F.explode("ts").alias("least"))
    common = known.select(F.explode("ts").alias("least")).groupBy("least").agg(F.count("*").alias("n_templates"))
    ranked = each.join(common, "least").withColumn("rank", F.row_number().over(Window.partitionBy("t").orderBy("n_templates", "least")))
    needed = F.ceil(containment * n - 1e-9)
    ranked = ranked.where((F.col("rank") <= n - needed + 1) & (needed < SAFE_SHARE * (most + n - needed)))
    return ranked.select("license", "t", "ts", F.lit(-1).alias("band"), "least")


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, bands: int = BANDS, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, containment)``: the best match of each license in each document.

    ``templates`` has ``license`` and ``template``.
    """
    known = templates.select("license", F.xxhash64("license", "template").alias("t"), _words(F.col("template")).alias("w")).dropDuplicates(["t"])
    known = known.select("license", "t", F.size("w").alias("n_words"), _shingles(F.col("w"), width).alias("ts")).withColumn("ts", F.array_distinct("ts"))
    facts = known.agg(F.max("n_words").alias("longest"), F.sum(F.size("ts")).alias("shingles"), F.count_if(F.col("ts").isNull()).alias("short")).first()
    if facts["short"] or not facts["longest"]:
        raise ValueError(f"templates need {width} words at least")
    blocks = 1 if facts["shingles"] <= MAX_SHINGLES else -(-2 * facts["shingles"] // MAX_SHINGLES)
    # words are a column of their own: inside the shingle's lambda an expression would be worked out for each place
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("page"), _words(F.col(text_col)).alias("w")).where(F.size("w") >= width)
    found = [_scan_block(split, known.where(F.pmod("t", F.lit(blocks)) == b) if blocks > 1 else known, int(facts["longest"]), width, bands, containment) for b in range(blocks)]
    return reduce(DataFrame.union, found).groupBy("doc_id", "page", "license").agg(F.max("share").alias("containment")).drop("page")


def _scan_block(split: DataFrame, known: DataFrame, half: int, width: int, bands: int, containment: float) -> DataFrame:
    universe = F.broadcast(known.select(F.explode("ts").alias("s")).distinct())
    hits = split.select("doc_id", "page", F.posexplode(_shingles(F.col("w"), width)).alias("at", "s")).join(universe, "s")
    block = F.floor(F.col("at") / half)
    windows = hits.select("doc_id", "page", "s", F.explode(F.array(block, block - 1)).alias("window"))
    windows = windows.groupBy("doc_id", "page", "window").agg(F.collect_set("s").alias("ws"))
    keys = F.concat(_signature(F.col("ws"), bands), F.transform("ws", lambda s: F.struct(F.lit(-1).alias("band"), s.alias("least"))))
    banded = windows.select("doc_id", "page", "ws", F.explode(keys).alias("x")).select("doc_id", "page", "ws", "x.*")
    wanted = known.select("license", "t", "ts", F.explode(_signature(F.col("ts"), bands)).alias("x")).select("license", "t", "ts", "x.*")
    wanted = wanted.union(_rare(known, 2 * half, containment))
    near = banded.join(F.broadcast(wanted), ["band", "least"])
    share = F.size(F.array_intersect("ws", "ts")) / F.size("ts")
    return near.select("doc_id", "page", "license", share.alias("share")).where(F.col("share") >= containment)


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, template string")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, default_templates(spark))
