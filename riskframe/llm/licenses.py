"""License scans: lines, paragraphs and whole texts compared with licence notices, by DataFrame operations only.

A segment and a template are compared by the Dice coefficient over word bigrams: twice the number of different
bigrams in common over the sum of the two numbers of bigrams. It reaches ``least`` only if the smaller number is at
least least / (2 - least) of the larger one, so a template is a candidate only for segments of a few sizes. The
templates' sizes are spelled out as rows, a small fixed table: candidates come from an equality join with it, and
segments of other sizes are dropped before their bigrams are made.

Words are runs of letters and digits in lower case. Documents are not shuffled; only hits are grouped.

Defined results: NULL text has no segments. Of a document's hits for a licence the best counts (then the first
template, then the first segment by code point). Rows that share a doc_id, or have none, count as one document.
Empty tables give an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8
# Notices of public licences, in one line each.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
}
WORD = r"[\p{L}\p{N}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: str) -> Column:
    return F.split(F.trim(F.lower(F.regexp_replace(F.col(text), NOT_WORD, " "))), " ")


def bigrams(of: Column) -> Column:
    """Pairs of neighbouring words, joined by a blank."""
    return F.zip_with(F.slice(of, 1, F.size(of) - 1), F.slice(of, 2, F.size(of)), lambda a, b: F.concat(a, F.lit(" "), b))


def templates(spark: SparkSession, least: float, own: dict[str, tuple[str, ...]]) -> DataFrame:
    """A row for each template and number of bigrams that a segment may have to reach ``least``."""
    rows = [(licence, i, t) for licence, texts in own.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "license string, template int, notice string").withColumn("w", words("notice"))
    df = df.where(F.size("w") > 1).withColumn("t_bigrams", bigrams(F.col("w"))).withColumn("t_size", F.size("t_bigrams"))
    share = least / (2 - least)
    # The bound is loosened by a hair: the coefficient itself decides.
    sizes = F.sequence(F.greatest(F.lit(1), F.ceil(F.col("t_size") * (share - 1e-9)).cast("int")), F.floor(F.col("t_size") / (share - 1e-9)).cast("int"))
    return df.select("license", "template", "t_bigrams", "t_size", F.explode(sizes).alias("size"))


def scan(docs: DataFrame, least: float = LEAST, own: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(doc_id, license, dice, template, segment): the best hit of each licence in each document."""
    known = templates(docs.sparkSession, least, own or TEMPLATES)
    by_size = known.groupBy("size").agg(F.collect_list(F.struct("license", "template", "t_bigrams", "t_size")).alias("near"))
    text = F.col("text")
    parts = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n"), F.array(text)))
    segments = docs.where(text.isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(parts).alias("segment"))
    segments = segments.withColumn("size", F.regexp_count("segment", F.lit(WORD)) - 1)
    # The table is fixed: notices times sizes, some thousands of rows.
    segments = segments.join(F.broadcast(by_size), "size").withColumn("w", words("segment")).withColumn("bigrams", bigrams(F.col("w")))
    pairs = segments.select("doc_id", "segment", "size", "bigrams", F.inline("near"))
    dice = F.lit(2.0) * F.size(F.array_intersect("bigrams", "t_bigrams")) / (F.col("size") + F.col("t_size"))
    hits = pairs.select("doc_id", "license", "template", "segment", F.round(dice, 6).alias("dice")).where(F.col("dice") >= least)
    best = F.min(F.struct((-F.col("dice")).alias("low"), "template", "segment")).alias("best")
    return hits.groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", (-F.col("best.low")).alias("dice"), F.col("best.template").alias("template"), F.col("best.segment").alias("segment")
    )
