"""Licence scan with DataFrame functions alone.

Sparse TF-IDF vectors are compared by cosine with known texts; the nearest one names the file's
licence.  Whole licence files and whole header blocks (the comments a file begins with; both also
from their first cue on) are compared with the full texts and file headers in ``licence_texts``,
which tells families apart; what they say goes first.  Without them, single lines and paragraphs
of several lines that may state a licence count: lines by their nearness to short notices,
paragraphs also to the full texts.  Files named like a
licence file speak for their directory; a file without a notice of its own inherits from the
nearest directory above it that has one, found by joining directories with their prefixes.

Term statistics of lines cover all candidate lines of all files; those of blocks cover the known
texts, so that a term only the corpus has (a holder's name) weighs least, and equal blocks are
compared once.  The AGPL's full text is the GPL's with its own name and section 13; of the CC BY
family only headers are known.  Directories, not files, are joined with
their ancestors, so a directory with a third of all files costs one row there; the notices are
a fixed table.

Defined results: a null text states nothing, a null path lies in no directory; of equally near
notices the first by name counts, of several licence files in a directory the nearest, then the
first by path; repeated rows are alike; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Short notices by which files name these licences.
NOTICES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike 4.0"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
CUE = r"(?i)licen[cs]e|copyright|spdx|creative commons|permission is hereby|redistribution and use"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
LEAST_COSINE = 0.6
TEXTS = Path(__file__).with_name("licence_texts")  # <licence>[.header*].txt
LEAST_BLOCK_COSINE = 0.75
WRAPPED_CUE = CUE.replace(" ", r"[^\p{L}\p{N}]+")
BLANK_LINES = r"\n[^\p{L}\p{N}]*\n"
TEXT_FILE = r"(?i)licen[cs]e|^(copying|notice|copyright)"  # speaks of licences as a whole
COMMENTED = r"^\uFEFF?\s*(?:#|//|/\*|<!--|<\?|\"\"\"|'''|\(\*|\{-|--|;|%|(?i:rem|dnl)\s|!|\.\.\s)"
LINE_COMMENT = r"^\uFEFF?\s*(?:$|#|//|--|;|%|!|\*|<\?|(?i:rem|dnl)\s|\.\.\s)"
BRACKETS = (("/*", "*/"), ("<!--", "-->"), ('"""', '"""'), ("'''", "'''"), ("(*", "*)"), ("{-", "-}"))
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"


def _terms(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0))


def _weights(lines: DataFrame, keys: list[str], idf: DataFrame, lines_total: int) -> DataFrame:
    """(keys, term, weight, norm) of lines that have columns keys and line; unseen terms weigh most."""
    counts = lines.select(*keys, F.explode(_terms("line")).alias("term")).groupBy(*keys, "term") \
        .agg(F.count(F.lit(1)).alias("tf"))
    weighed = counts.join(idf, "term", "left").withColumn(
        "weight", F.col("tf") * (F.log(F.lit(1.0 + lines_total) / (1 + F.coalesce("df", F.lit(0)))) + 1)).drop("tf", "df")
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighed.join(norms, keys)


def own_licences(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``(file, licence, score)`` of the files of (file, text) that state one."""
    lines = stored(files.filter(F.col("text").rlike(CUE))
                   .select("file", F.posexplode(F.split("text", "\n")).alias("at", "line"))
                   .filter(F.col("line").rlike(CUE)), "licence-lines")
    total = lines.count()
    df = stored(lines.select("file", "at", F.explode(F.array_distinct(_terms("line"))).alias("term"))
                .groupBy("term").agg(F.count(F.lit(1)).alias("df")), "licence-terms")
    notices = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(NOTICES)],
                                    "notice int, licence string, line string")
    known = _weights(notices, ["notice", "licence"], df, total) \
        .withColumnsRenamed({"weight": "notice_weight", "norm": "notice_norm"})
    cosine = F.sum(F.col("weight") * F.col("notice_weight")) / (F.first("norm") * F.first("notice_norm"))
    near = _weights(lines, ["file", "at"], df, total).join(known, "term").groupBy("file", "at", "notice", "licence") \
        .agg(cosine.alias("score")).filter(F.col("score") >= LEAST_COSINE)
    best = F.max(F.struct(F.round("score", 4).alias("score"), (-F.col("notice")).alias("n"), "licence"))
    return near.groupBy("file").agg(best.alias("best")).select("file", "best.licence", "best.score")


@cache
def _known() -> tuple[list[tuple[str, str, str, float]], list[tuple[str, float]]]:
    """(text, licence, term, weight) of the known texts, each of length 1; (term, idf) of their terms."""
    texts = [(p.stem, p.stem.split(".header")[0], p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    texts += [(f"notice {k:02}", name, line) for k, (name, line) in enumerate(NOTICES)]
    counts = [(key, name, Counter(re.findall(TERM, text.lower()))) for key, name, text in texts]
    df = Counter(term for _, _, own in counts for term in own)
    idf = {term: math.log((1 + len(texts)) / (1 + n)) + 1 for term, n in df.items()}
    rows = []
    for key, name, own in counts:
        weights = {term: (1 + math.log(tf)) * idf[term] for term, tf in own.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(key, name, term, w / norm) for term, w in weights.items()]
    return rows, sorted(idf.items())


def _header(text: str) -> Column:
    """The comments that a text begins with."""
    lines = F.split(text, "\n")

    def step(at: Column, line: Column) -> Column:
        bare, more = F.trim(line), (at["n"] + 1).alias("n")
        closer = F.lit("")
        for start, end in BRACKETS:
            rest = F.substr(bare, F.lit(len(start) + 1))
            closer = F.when(bare.startswith(start), F.when(rest.contains(end), "").otherwise(end)).otherwise(closer)
        opened = F.lit(False)
        for start, _ in BRACKETS:
            opened = opened | bare.startswith(start)
        going, over = F.lit(False).alias("ended"), F.lit(True).alias("ended")
        return F.when(at["ended"], at) \
            .when(at["closer"] != "", F.struct(F.when(line.contains(at["closer"]), "").otherwise(at["closer"]).alias("closer"), more, going)) \
            .when(opened, F.struct(closer.alias("closer"), more, going)) \
            .when(line.rlike(LINE_COMMENT), F.struct(F.lit("").alias("closer"), more, going)) \
            .otherwise(F.struct(F.lit("").alias("closer"), at["n"].alias("n"), over))

    first = F.struct(F.lit("").alias("closer"), F.lit(0).alias("n"), F.lit(False).alias("ended"))
    return F.array_join(F.slice(lines, 1, F.aggregate(lines, first, step)["n"]), "\n")


def block_licences(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``(file, whole, licence, score)`` of the files of (file, path, text) by their blocks: the nearest
    known text to its header or whole text (``whole``), and to its paragraphs of several lines."""
    named = F.coalesce(F.regexp_extract(F.col("path"), r"([^/]*)$", 1).rlike(TEXT_FILE), F.lit(False))
    wholes = files.filter(named).select("file", "text").unionByName(
        files.filter(~named & F.col("text").rlike(COMMENTED)).select("file", _header("text").alias("text")))
    tail = F.regexp_extract("text", r"(?ms)^[^\n]*(?:" + WRAPPED_CUE + r").*\z", 0)
    wholes = wholes.filter("text IS NOT NULL").select("file", F.lit(True).alias("whole"), F.explode(F.array("text", tail)).alias("block"))
    cue = F.col("text").rlike(WRAPPED_CUE)
    paragraphs = files.filter(cue).select("file", F.lit(False).alias("whole"), F.explode(F.split("text", BLANK_LINES)).alias("block")) \
        .filter(F.col("block").contains("\n") & F.col("block").rlike(WRAPPED_CUE))
    blocks = stored(wholes.filter("block <> ''").unionByName(paragraphs)
                    .select("file", "whole", F.sha2("block", 256).alias("key"), "block"), "licence-blocks")
    rows, idf = _known()
    known = stored(spark.createDataFrame(rows, "known string, licence string, term string, known_weight double"), "known-texts")
    idf = stored(spark.createDataFrame(idf, "term string, idf double"), "known-terms")
    counts = blocks.groupBy("key").agg(F.first("block").alias("block")) \
        .select("key", F.explode(_terms("block")).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = stored(counts.join(idf, "term", "left")
                     .select("key", "term", ((1 + F.log("tf")) * F.coalesce("idf", F.lit(1.0))).alias("weight")), "block-terms")
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    near = weighed.join(known, "term").groupBy("key", "known", "licence") \
        .agg(F.sum(F.col("weight") * F.col("known_weight")).alias("dot")).join(norms, "key") \
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 4)).filter(F.col("score") >= LEAST_BLOCK_COSINE)
    place = F.struct((-F.col("score")).alias("s"), "licence")
    nearest = near.groupBy("key").agg(F.min(place).alias("any"), F.min(F.when(~F.col("known").startswith("notice "), place)).alias("text"))
    return blocks.select("file", "whole", "key").join(nearest, "key") \
        .withColumn("best", F.when(F.col("whole"), F.col("text")).otherwise(F.col("any"))).filter("best IS NOT NULL") \
        .groupBy("file", "whole").agg(F.min("best").alias("best")).select("file", "whole", "best.licence", (-F.col("best.s")).alias("score"))


def _folder(path: str) -> Column:
    """Everything before the last slash; null without one."""
    folder = F.regexp_extract(F.col(path), r"(?s)^(.*)/[^/]*$", 1)
    return F.when(F.col(path).contains("/"), folder)


def scan(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of (file, path, text), ``file`` a number of the row, → file, path, licence, origin, score."""
    stated = own_licences(spark, files.select("file", "text")).select("file", F.lit(False).alias("whole"), F.lit(True).alias("line"), "licence", "score") \
        .unionByName(block_licences(spark, files).select("file", "whole", F.lit(False).alias("line"), "licence", "score"))
    first = F.max(F.struct("whole", "score", "line", "licence")).alias("best")
    own = stored(stated.groupBy("file").agg(first).select("file", "best.licence", "best.score"), "own-licences")
    placed = files.select("file", "path", _folder("path").alias("folder")).join(own, "file", "left")
    named = F.regexp_extract(F.col("path"), r"([^/]*)$", 1).rlike(LICENCE_FILE)
    spoken = placed.filter(named & F.col("licence").isNotNull() & F.col("folder").isNotNull()).groupBy("folder") \
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "licence")).alias("first")) \
        .select("folder", F.col("first.licence").alias("above"))
    spoken = stored(spoken, "licence-folders")
    parts = F.split("folder", "/")
    ancestors = placed.select("folder").filter("folder IS NOT NULL").distinct() \
        .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts)))) \
        .select(F.col("folder").alias("below"), "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("folder"))
    nearest = ancestors.join(spoken, "folder").groupBy(F.col("below").alias("folder")) \
        .agg(F.max(F.struct("depth", "above")).alias("last")).select("folder", F.col("last.above").alias("inherited"))
    return placed.join(nearest, "folder", "left").select(
        "file", "path", F.coalesce("licence", "inherited").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
        .alias("origin"), "score")
