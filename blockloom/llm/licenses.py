"""Licences of files: TF-IDF cosine to templates, then inheritance along directories.

DataFrame functions only. Every line of a file is a unit, and so is the whole text of
a licence file. Units and templates become sparse vectors of term frequency times
inverse document frequency, over the words of all files. The words' counts are added
up before they are shuffled. A unit's words outside the templates weigh at least their
number, so most units can't reach ``LEAST`` whatever the files hold; these are left
where they are, and only the others' words are joined with their frequencies. The best
template of a unit counts from ``LEAST`` on, if both agree on what tells licences of one
family apart: the template's numbers are in the unit, and words like Lesser or
NonCommercial are in both or in neither. A unit that denies a licence has none. A file
without a licence of its own takes that of the nearest directory above it that holds a
licence file; if the terms of these are not known, neither is the file's licence.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm.shared import ascii_lower, computed, settle, spread_join

LEAST = 0.6
#: What rounding may take from a similarity.
SLACK = 1e-8
#: So many paths that several rows have are broadcast.
FEW = 100_000
#: Names of licence files, at their beginning.
LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"
PARTING = r"[^\p{L}\p{Nd}]+"

#: Words that say nothing about a licence.
COMMON = "a an and any are as at be by for from in is it its may not of on or that the this to with you your".split()

#: Creative Commons licences with terms: short and long names.
COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

#: Licences of one family, by name and version.
GNU = {
    "GPL-2.0": ("GNU General Public License", "2"),
    "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License", "3"),
    "AGPL-3.0": ("GNU Affero General Public License", "3"),
}

#: Words that tell licences of one family apart, and what denies a licence.
TELLING = "affero lesser library sa nc nd sharealike noncommercial noderivatives noderivs".split()
DENIED = r"(?i)\b(not|never|no longer)\s+(be\s+)?(released|licensed|available|covered|distributed)\b"

#: Identifiers that a file may name in a line of its own.
IDENTIFIERS = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 Zlib Unlicense CC0-1.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later "
    "LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later"
).split()

#: Sentences by which a licence is known, several for most.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
        "in compliance with the License.",
    ),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
    ),
    *(
        (f"{name}-or-later", sentence)
        for name, (long, version) in GNU.items()
        for sentence in (
            f"Released under the {long} version {version}.",
            f"This program is free software: you can redistribute it and/or modify it under the terms of the "
            f"{long} as published by the Free Software Foundation, either version {version} of the License, "
            "or (at your option) any later version.",
        )
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted",
    ),
    *(
        (f"CC-{short}-{version}", sentence)
        for short, long in COMMONS.items()
        for version, reach in (("4.0", "International"), ("3.0", "Unported"))
        for sentence in (
            f"Licensed under CC {short} {version}.",
            f"Licensed under the Creative Commons {long} {version} {reach} License.",
            f"This work is licensed under a Creative Commons {long} {version} {reach} License.",
            f"SPDX-License-Identifier: CC-{short}-{version}",
        )
    ),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-proprietary", "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS),
]


def templates(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(known or TEMPLATES, "license string, text string")


def _words(text: Column) -> Column:
    """Words that say something, as often as they come."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), PARTING)
    return F.filter(split, lambda w: ~w.isin("", *COMMON))


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def frequencies(files: DataFrame) -> DataFrame:
    """term and df, the number of paths whose rows have it, for all words of ``files``."""
    files = files.select(F.coalesce("path", F.lit("")).alias("path"), "text")
    again = settle(files.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1").select("path"))
    repeated = again.count()
    if repeated <= FEW:
        again = F.broadcast(again)
    lone = files.join(again, "path", "left_anti") if repeated else files
    term = F.explode(F.array_distinct(_words(F.col("text")))).alias("term")
    terms = lone.select(term)
    if repeated:
        terms = terms.unionByName(
            files.join(again, "path", "left_semi").select("path", term).distinct().select("term")
        )
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def own_licenses(files: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """path, license and similarity of the best match of each file that has one."""
    # templates are fixed, so their words and frequencies fit into one row
    listed = F.collect_set(F.struct("license", _words(F.col("text")).alias("words"))).alias("all")
    texts = [(r["license"], Counter(r["words"])) for r in known.agg(listed).first()["all"] if r["words"]]
    terms = sorted(set().union(*(words for _, words in texts)))
    n_files = files.select(F.coalesce("path", F.lit(""))).distinct().count()
    df = settle(frequencies(files))
    counted = df.filter(F.col("term").isin(terms)).agg(F.collect_list(F.struct("term", "df")).alias("all"))
    counts = {r["term"]: r["df"] for r in counted.first()["all"]}
    weight = {w: math.log((1 + n_files) / (1 + counts.get(w, 0))) + 1 for w in terms}
    sides, share = [], dict.fromkeys(terms, 0.0)
    for name, words in texts:
        norm = math.sqrt(sum((n * weight[w]) ** 2 for w, n in words.items()))
        marks = sorted(w for w in words if w.isdigit() or w in TELLING)
        sides.append((name, {w: n * weight[w] / norm for w, n in words.items()}, marks))
        for w, part in sides[-1][1].items():
            share[w] = max(share[w], part**2)
    model = F.broadcast(
        files.sparkSession.createDataFrame(
            [(weight, share, sides)],
            "weight map<string,double>, share map<string,double>, "
            "sides array<struct<license string, parts map<string,double>, marks array<string>>>",
        )
    )

    def add(values: Column, each) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda sum, x: sum + F.coalesce(each(x), F.lit(0.0)))

    telling = F.array(*map(F.lit, TELLING))
    path = F.coalesce("path", F.lit("")).alias("path")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    whole = F.when(_name(F.coalesce("path", F.lit(""))).rlike(LICENSE_FILE), F.array("text")).otherwise(
        F.array().cast("array<string>")
    )
    units = computed(
        files.select(path, F.explode(F.concat(lines, whole)).alias("line")).filter(~F.col("line").rlike(DENIED)).select(
            "path", F.xxhash64("line").alias("unit"), _words(F.col("line")).alias("words")
        )
    )
    held = F.filter("words", lambda w: w.isin(terms))
    sharing = computed(units.withColumn("held", held)).filter(F.size("held") > 0).crossJoin(model)
    # the part of a template that a unit has bounds their similarity
    sharing = sharing.filter(
        add(F.array_distinct("held"), lambda w: F.col("share")[w]) >= least**2 - SLACK
    )
    sharing = computed(
        sharing.select(
            "path",
            "unit",
            F.filter("words", lambda w: ~w.isin(terms)).alias("foreign"),
            add(
                F.array_distinct("held"),
                lambda w: F.pow(F.col("weight")[w] * F.size(F.filter("held", lambda v: v == w)), F.lit(2)),
            ).alias("square"),
            F.transform(
                "sides",
                lambda t: F.struct(
                    add(F.col("held"), lambda w: F.col("weight")[w] * t["parts"][w]).alias("dot"),
                    t["license"].alias("license"),
                    (
                        (F.size(F.array_except(t["marks"], F.col("held"))) == 0)
                        & (F.size(F.array_except(F.array_intersect(F.col("held"), telling), t["marks"])) == 0)
                    ).alias("agrees"),
                ),
            ).alias("matches"),
        )
    )
    # no word weighs less than 1
    bound = (least - SLACK) * F.sqrt(F.col("square") + F.size("foreign"))
    able = F.filter("matches", lambda m: m["agrees"] & (m["dot"] > 0) & (m["dot"] >= bound))
    able = sharing.withColumn("matches", able).filter(F.size("matches") > 0)
    able = settle(able.dropDuplicates(["path", "unit"]))
    foreign = able.select("path", "unit", F.explode("foreign").alias("term"))
    foreign = foreign.groupBy("path", "unit", "term").agg(F.count("*").alias("tf"))
    weighed = F.col("tf") * (F.log((1 + F.lit(n_files)) / (1 + F.col("df"))) + 1)
    foreign = (
        spread_join(foreign, df, ["term"], "path")
        .groupBy("path", "unit")
        .agg(F.sum(F.pow(weighed, F.lit(2))).alias("rest"))
    )
    norm = F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0)))
    best = F.array_max(
        F.transform(
            "matches",
            lambda m: F.struct(F.round(m["dot"] / F.col("norm"), 9).alias("similarity"), m["license"].alias("license")),
        )
    )
    return (
        able.join(foreign, ["path", "unit"], "left")
        .select("path", "matches", norm.alias("norm"))
        .select("path", best.alias("best"))
        .filter(F.col("best.similarity") >= least)
        .groupBy("path")
        .agg(F.max("best").alias("best"))
        .select("path", F.col("best.license").alias("license"), F.col("best.similarity").alias("similarity"))
    )


def scan(files: DataFrame, known: DataFrame | None = None, least: float = LEAST) -> DataFrame:
    """One row per row of ``files``: path, license, similarity, origin and directory.

    ``origin`` is ``own`` where a unit of the file matches, ``inherited`` where a licence
    file in the nearest directory above that holds any does, ``unknown`` where none there
    does (license and similarity are NULL), and NULL where no directory above holds one.
    A licence file without a match is ``unknown`` itself. ``directory`` is where the
    licence files lie that decide. Of equal
    similarities the last licence by name counts, of several licence files in one
    directory the most similar. Repeated paths are one file of all their lines. A NULL
    path is an empty one, a NULL text has no lines; other columns are dropped.
    """
    files = files.select("path", "text")
    own = settle(own_licenses(files, known or templates(files.sparkSession), least))
    at = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    named = _name(F.col("path")).rlike(LICENSE_FILE)
    paths = files.select(F.coalesce("path", F.lit("")).alias("path"))
    # One row for each directory with licence files; a known licence goes before unknown terms.
    given = (
        paths.distinct()
        .filter(named)
        .join(own, "path", "left")
        .select(at.alias("directory"), F.struct("similarity", "license").alias("best"))
        .groupBy("directory")
        .agg(F.max("best").alias("best"))
    )
    lone = paths.distinct().join(own, "path", "left_anti")
    parts = F.split("path", "/")
    above = lone.select(
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/")
            )
        ).alias("directory"),
    )
    nearest = spread_join(above, given, ["directory"], "path").groupBy("path").agg(
        F.max(F.struct(F.length("directory").alias("depth"), F.col("directory"), F.col("best"))).alias("near")
    )
    none = F.lit(None).cast("string")
    taken = F.when(~named, F.col("near.best"))
    found = own.select("path", "license", "similarity", F.lit("own").alias("origin"), none.alias("directory"))
    found = found.unionByName(
        nearest.select(
            "path",
            taken["license"].alias("license"),
            taken["similarity"].alias("similarity"),
            F.when(taken["license"].isNull(), F.lit("unknown")).otherwise(F.lit("inherited")).alias("origin"),
            F.col("near.directory").alias("directory"),
        )
    )
    return paths.join(found, "path", "left")
