"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from directories.

DataFrame functions only. Units of a text are the whole, its blocks (runs of lines with
letters or digits, as wrapped headers are) and the lines of a block; each is compared
with the templates. Words are runs of a-z and 0-9 in lower case; the weight of a template
term falls with the share of all documents that have it, any other word weighs 1 in
the length of its unit.

Units that cannot match are told by ``telling_terms``: a unit's cosine is at most the length
of the part of the template, itself of length 1, whose terms it holds. So of each
template the most common terms are left out as long as they alone stay below
``MIN_COSINE``, and a unit without any of the others is not scored. That loses no match.
Of the others only template terms are exploded.

A file's own licence is its best match at or above ``MIN_COSINE``. A matching block is one
notice, in other blocks each matching line is. A licence file, by its name or because
notices hold at least half of its words, speaks for its directory. A file without a
licence of its own takes that of the nearest directory above it. Directories, not files,
are joined to their ancestors, and files to their directory, so that a directory with a
third of all files is a skewed join that Spark splits, not a group. Templates are
literals; nothing that grows is broadcast by hint.

Defined results: a null or empty text has no licence of its own and may inherit; ties
of score go to the smaller licence id, ties of licence files to the higher score, then
the smaller path; repeated rows stay, and rows of one path are one file with the best
match and all notices of its different texts; a null path has no directory; an empty
table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.session import stage

MIN_COSINE = 0.6
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|copyright|notice|unlicense)[^/]*$"

# Short notices of public licences.
TEMPLATES = [
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License"),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: redistributions of source code "
        "must retain the above copyright notice",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
    ),
    ("lgpl-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("proprietary", "All rights reserved"),
    ("proprietary", "Copyright. All rights reserved. No part may be reproduced without permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Lines without letters or digits part blocks; the quantifiers never give back.
BETWEEN_BLOCKS = r"\n(?:[^A-Za-z0-9\n]*+\n)++"

TERM = "[a-z0-9]+"


def _terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


VOCABULARY = sorted({t for _, text in TEMPLATES for t in _terms(text)})


def template_rows() -> list[tuple[int, str, str, int]]:
    """Template number, licence id, term and its count."""
    return [
        (i, name, term, _terms(text).count(term))
        for i, (name, text) in enumerate(TEMPLATES)
        for term in sorted(set(_terms(text)))
    ]


def literal_rows(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals; the strings hold a-z, 0-9, dots and dashes only."""
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TERM})"), F.lit(1))


def term_weights(files: DataFrame) -> DataFrame:
    """term and weight of every template term, from all texts."""
    known = F.array_intersect(words(F.col("text")), F.array(*map(F.lit, VOCABULARY)))
    # one more entry a file counts the files
    seen = files.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("term"))
    seen = seen.groupBy("term").agg(F.count("*").alias("df"))
    total = seen.filter("term = ''").select(F.col("df").alias("total"))
    every = literal_rows(files.sparkSession, "term", [(t,) for t in VOCABULARY])
    # one row
    return every.join(seen, "term", "left").join(F.broadcast(total), how="left").select(
        "term",
        (
            F.log((F.coalesce("total", F.lit(0)) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
        ).alias("weight"),
    )


def telling_terms(weights: dict[str, float]) -> list[str]:
    """Terms of which a unit must hold one to come near any template."""
    # scores are rounded before they are compared
    least, found = (MIN_COSINE - 1e-6) ** 2 - 1e-9, set()
    for _, text in TEMPLATES:
        terms = _terms(text)
        squares = {t: (terms.count(t) * weights[t]) ** 2 for t in set(terms)}
        rest, whole = 0.0, sum(squares.values())
        for term in sorted(squares, key=lambda t: (weights[t], t)):
            rest += squares[term] / whole
            if rest >= least:
                found.add(term)
    return sorted(found)


def _known(words_: Column) -> Column:
    return F.array_intersect(words_, F.array(*map(F.lit, VOCABULARY)))


def _sum_of_squares(words_: Column) -> Column:
    """Of how often each different word occurs."""
    start = F.struct(F.lit("").alias("word"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sum"))

    def count(seen: Column, word: Column) -> Column:
        n = F.when(seen["word"] == word, seen["n"] + 1).otherwise(1)
        return F.struct(word.alias("word"), n.alias("n"), (seen["sum"] + 2 * n - 1).alias("sum"))

    return F.aggregate(F.array_sort(words_), start, count, lambda seen: seen["sum"])


def _units(files: DataFrame, telling: list[str]) -> DataFrame:
    """path, text_key, all_words, block, line and words of all units that can match; block 0
    is the whole text, line 0 a whole block."""
    may_match = lambda words_: F.arrays_overlap(words_, F.array(*map(F.lit, telling)))
    texts = files.filter("path IS NOT NULL AND text IS NOT NULL")
    split = texts.select("path", "text", words(F.col("text")).alias("words"))
    split = split.filter(may_match(F.col("words")))
    keyed = split.select("path", "text", F.size("words").alias("all_words"), F.md5("text").alias("text_key"))
    whole = F.array(F.struct(F.lit(0).alias("block"), F.col("text").alias("part")))
    parts = F.transform(
        F.split("text", BETWEEN_BLOCKS, -1), lambda b, i: F.struct((i + 1).alias("block"), b.alias("part"))
    )
    blocks = keyed.select("path", "text_key", "all_words", F.inline(F.concat(whole, parts)))
    blocks = blocks.withColumn("words", words(F.col("part")))
    blocks = blocks.filter((F.col("block") == 0) | may_match(F.col("words")))
    entry = lambda line, words_: F.struct(line.cast("int").alias("line"), words_.alias("words"))
    lines = F.transform(F.split("part", "\n", -1), lambda x, i: entry(i + 1, words(x)))
    lines = F.filter(lines, lambda x: may_match(x["words"]))
    own = F.array(entry(F.lit(0), F.col("words")))
    has_lines = (F.col("block") > 0) & F.contains("part", F.lit("\n"))
    units = F.when(has_lines, F.concat(own, lines)).otherwise(own)
    return blocks.select("path", "text_key", "all_words", "block", F.inline(units))


def matches(files: DataFrame) -> DataFrame:
    """Units near a template: path, text_key, block, line (see ``_units``), n_words of the
    unit, all_words of the text, license_id, score. Rows of one path and text are one."""
    spark = files.sparkSession
    weights = stage(term_weights(files), "license-weights")
    # as many rows as the templates have terms
    telling = telling_terms({r.term: r.weight for r in weights.collect()})
    templates = literal_rows(spark, "template, license_id, term, n", template_rows())
    templates = templates.join(weights, "term").withColumn("w", F.col("n") * F.col("weight"))
    norms = templates.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    templates = templates.join(norms, "template").select(
        "template", "license_id", "term", (F.col("w") / F.col("template_norm")).alias("w")
    )

    key = ["path", "text_key", "block", "line", "n_words", "all_words"]
    count = lambda t: F.size(F.filter("words", lambda x: x == t)).cast("long")
    terms = F.transform(_known(F.col("words")), lambda t: F.struct(t.alias("term"), count(t).alias("n")))
    units = _units(files, telling).withColumn("n_words", F.size("words"))
    counts = units.select(*key, _sum_of_squares(F.col("words")).alias("squares"), F.inline(terms)).distinct()
    counts = counts.join(weights, "term").withColumn("w", F.col("n") * F.col("weight"))
    counts = stage(counts.drop("weight"), "license-terms")
    # words that no template has weigh 1
    others = F.max("squares") - F.sum(F.col("n") * F.col("n"))
    length = counts.groupBy(*key).agg(F.sqrt(others + F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        counts.join(templates.withColumnRenamed("w", "tw"), "term")
        .groupBy(*key, "template", "license_id")
        .agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    )
    scored = dots.join(length, key).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = scored.filter(F.col("score") >= MIN_COSINE).groupBy(*key).agg(
        F.max(F.struct("score", -F.col("template"), "license_id")).alias("best")
    )
    return best.select(
        *key, F.col("best.license_id").alias("license_id"), F.col("best.score").alias("score")
    )


def own_licenses(files: DataFrame) -> DataFrame:
    """One row per path with a match: path, license_id, score, n_notices, is_license_file."""
    found = matches(files)
    in_line = F.col("line") > 0
    blocks = found.groupBy("path", "text_key", "block").agg(
        F.max("all_words").alias("all_words"),
        F.max((~in_line).cast("int")).alias("as_block"),
        F.count_if(in_line).alias("n_lines"),
        F.sum(F.when(in_line, F.col("n_words")).otherwise(0)).alias("line_words"),
        F.max(F.when(~in_line, F.col("n_words"))).alias("block_words"),
        F.max("score").alias("score"),
        F.collect_set(F.struct("score", "license_id")).alias("found"),
    )
    noted = (F.col("block") > 0).cast("long")
    best = blocks.groupBy("path").agg(
        F.max("score").alias("score"),
        F.sum(noted * F.when(F.col("as_block") == 1, 1).otherwise(F.col("n_lines"))).alias("n_notices"),
        F.sum(noted * F.coalesce("block_words", "line_words")).alias("noted_words"),
        F.max("all_words").alias("all_words"),
        F.max((F.col("block") == 0).cast("int")).alias("whole"),
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("found"),
    )
    # at most one entry a licence and score: the smallest id of the best score
    of_best = F.array_min(F.transform(F.filter("found", lambda x: x["score"] == F.col("score")), lambda x: x["license_id"]))
    return best.select(
        "path",
        of_best.alias("license_id"),
        "score",
        "n_notices",
        (
            F.col("path").rlike(FILE_NAME)
            | (F.col("whole") == 1)
            | (F.col("noted_words") >= FILE_SHARE * F.col("all_words"))
        ).alias("is_license_file"),
    )


def directory(path: Column) -> Column:
    """The directory of a path; '' is the root, null above it."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``files`` (path, text): path, own_license, score, n_notices,
    is_license_file, license_id, from_dir (null: own or none), and the columns ``keep``."""
    own = stage(own_licenses(files.select("path", "text")), "license-own")
    speaking = own.filter("is_license_file").groupBy(directory(F.col("path")).alias("above")).agg(
        F.min(F.struct(-F.col("score"), F.col("path"), F.col("license_id"))).alias("l")
    ).select("above", F.col("l.license_id").alias("dir_license"))

    directories = files.filter("path IS NOT NULL").select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/", -1)
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    ancestors = directories.select(
        "dir", F.explode(F.sequence(F.lit(0), depth)).alias("depth")
    ).withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    inherited = ancestors.join(speaking, "above").groupBy("dir").agg(
        F.max(F.struct("depth", "above", "dir_license")).alias("l")
    ).select("dir", F.col("l.above").alias("from_dir"), F.col("l.dir_license").alias("dir_license"))
    inherited = stage(inherited, "license-dirs")

    rows = files.select("path", directory(F.col("path")).alias("dir"), F.struct(*keep).alias("kept") if keep else F.lit(0).alias("kept"))
    rows = rows.join(own, "path", "left").join(inherited, "dir", "left")
    has_own = F.col("license_id").isNotNull()
    return rows.select(
        "path",
        F.col("license_id").alias("own_license"),
        "score",
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("is_license_file", F.lit(False)).alias("is_license_file"),
        F.coalesce("license_id", "dir_license").alias("license_id"),
        F.when(~has_own, F.col("from_dir")).alias("from_dir"),
        *(["kept.*"] if keep else []),
    )
