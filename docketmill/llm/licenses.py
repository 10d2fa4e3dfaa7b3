"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance.

Lines that hold a cue, and paragraphs that do (lines between which there is none
without a letter or digit, so a header that is wrapped is one), are compared with
licence templates by the cosine of sparse TF-IDF vectors.  The weights come from
the number of documents that hold each term of the templates, counted over all
documents; a term that no template has weighs as one that no document has, so
unrelated words lower the cosine.  A file has the licence of its best line or
paragraph, or, where it is named as a licence file, of its whole text if that is
better.  The terms of a text are counted by sorting them, so the work on a very
long line or paragraph grows as its length does, but for the sorting.

A file without a licence of its own takes that of the nearest directory above it
that has a licence file.  Files are joined to licence files by each of the paths
above them, and the longest one decides; licence files are reduced to one for
each directory before, and only paths and identifiers are shuffled, not texts.

Defined cases: a NULL or empty text has no licence of its own; a NULL path has no
directory and inherits nothing; of equal cosines the licence that sorts first
counts, and of several licence files in a directory the one with the greatest
cosine, then the first path; repeated rows get equal results; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.functions.text import bind, runs
from docketmill.llm.common import materialized

# Notices by which files name their licence, and the headers the licences recommend.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}

#: A line or paragraph that holds none of these is not compared.
CUE = "(?i)licen[cs]e|copyright|permission is hereby"
#: Names of files that speak for their directory.
FILE_NAME = "(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
TERM = "[a-z0-9]+"
#: What lies between paragraphs, line breaks being line feeds.
GAP = r"\n[^\p{L}\p{N}]*\n"
LEAST_COSINE = 0.7


@dataclass
class Weights:
    """Inverse document frequencies of the terms of the templates, and of any other term."""

    known: dict[str, float]
    other: float


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _template_terms() -> dict[str, list[list[str]]]:
    import re

    return {name: [re.findall(TERM, t.lower()) for t in texts] for name, texts in TEMPLATES.items()}


def weights(docs: DataFrame) -> Weights:
    """Weights from all documents; collected is one number for each term of the templates."""
    vocabulary = sorted({t for texts in _template_terms().values() for text in texts for t in text})
    held = F.array_intersect(F.array(*[F.lit(t) for t in vocabulary]), terms(F.col("text")))
    counts = docs.select(F.explode(held).alias("term")).groupBy("term").count().collect()
    found = {r["term"]: r["count"] for r in counts}
    n = docs.count()
    return Weights({t: math.log((1 + n) / (1 + found.get(t, 0))) + 1 for t in vocabulary}, math.log(1 + n) + 1)


def _vectors(found: Weights) -> list[tuple[str, dict[str, float]]]:
    """Unit vectors of all templates."""
    vectors = []
    for name, texts in sorted(_template_terms().items()):
        for text in texts:
            raw = {t: text.count(t) * found.known[t] for t in set(text)}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            vectors.append((name, {t: v / norm for t, v in sorted(raw.items())}))
    return vectors


def best_template(text: Column, found: Weights) -> Column:
    """struct(cosine, license) of the template nearest to a text."""
    weight = F.create_map(*[F.lit(x) for t, w in found.known.items() for x in (t, w)])

    def squares(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v * v)

    def nearest(counts: Column) -> Column:
        known = F.filter(counts, lambda r: r["item"].isin(*found.known))
        others = F.transform(F.filter(counts, lambda r: ~r["item"].isin(*found.known)), lambda r: r["cnt"] * F.lit(found.other))
        values = F.transform(known, lambda r: r["cnt"] * weight[r["item"]])
        vector = F.map_from_arrays(F.transform(known, lambda r: r["item"]), values)
        return bind(F.struct(vector.alias("v"), F.sqrt(squares(values) + squares(others)).alias("norm")), best)

    def best(own: Column) -> Column:
        scores = []
        for name, template in _vectors(found):
            dot = F.lit(0.0)
            for t, w in template.items():
                dot = dot + F.coalesce(F.try_element_at(own["v"], F.lit(t)), F.lit(0.0)) * w
            cosine = F.when(own["norm"] > 0, dot / own["norm"]).otherwise(0.0)
            scores.append(F.struct((-F.round(cosine, 9)).alias("minus"), F.lit(name).alias("license")))
        return F.array_min(F.array(*scores))

    least = bind(runs(F.sort_array(terms(text))), nearest)
    return F.struct((-least["minus"]).alias("cosine"), least["license"].alias("license"))


def own_licenses(files: DataFrame, found: Weights, least: float = LEAST_COSINE) -> DataFrame:
    """(doc_id, path, cosine, license) of every file (doc_id, path, text); no licence is NULL."""
    none = F.array().cast("array<string>")
    is_file = F.coalesce(F.regexp_like(F.element_at(F.split("path", "/"), -1), F.lit(FILE_NAME)), F.lit(False))

    def holding(parts: Column) -> Column:
        return F.filter(parts, lambda s: F.regexp_like(s, F.lit(CUE)))

    paragraphs = F.split(F.regexp_replace("text", "\r\n?", "\n"), GAP)
    whole = F.when(is_file, F.array(F.col("text"))).otherwise(none)
    held = F.when(F.regexp_like("text", F.lit(CUE)), F.concat(
        holding(F.split("text", "\\R")), holding(paragraphs), whole)).otherwise(none)
    split = files.select("doc_id", "path", F.explode_outer(F.array_distinct(held)).alias("line"))
    scored = split.select("doc_id", "path", F.when(F.col("line").isNotNull(), best_template(F.col("line"), found)).alias("b"))
    enough = F.when(F.col("b.cosine") >= least, F.struct((-F.col("b.cosine")).alias("minus"), "b.license"))
    best = scored.groupBy("doc_id", "path").agg(F.min(enough).alias("best"))
    return best.select("doc_id", "path", (-F.col("best.minus")).alias("cosine"), "best.license")


def _above(path: Column) -> Column:
    """The directories above a path, nearest first; the topmost is empty."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def inherited(own: DataFrame) -> DataFrame:
    """(doc_id, path, own_license, cosine, license, origin) of every file as `own_licenses` gives them.

    `origin` is `file`, `header`, `directory` or `none`.
    """
    is_file = F.coalesce(F.regexp_like(F.element_at(F.split("path", "/"), -1), F.lit(FILE_NAME)), F.lit(False))
    licensed = own.where(is_file & F.col("license").isNotNull())
    directories = licensed.groupBy(F.element_at(_above(F.col("path")), 1).alias("directory")).agg(
        F.min(F.struct((-F.col("cosine")).alias("minus"), "path", "license")).alias("best")).select(
        "directory", F.col("best.license").alias("directory_license"))
    missing = own.where(F.col("license").isNull() & F.col("path").isNotNull()).select("path").distinct()
    ways = missing.select("path", F.posexplode(_above(F.col("path"))).alias("steps", "directory"))
    nearest = ways.join(directories, "directory").groupBy("path").agg(
        F.min(F.struct("steps", "directory_license")).alias("n")).select(
        F.col("path").alias("near_path"), F.col("n.directory_license").alias("near"))
    joined = own.join(nearest, F.col("path") == F.col("near_path"), "left")
    has = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path", F.col("license").alias("own_license"), "cosine",
        F.when(has, F.col("license")).otherwise(F.col("near")).alias("license"),
        F.when(has & is_file, "file").when(has, "header").when(F.col("near").isNotNull(), "directory").otherwise(
            "none").alias("origin"))


def scan(files: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Licences of all files (doc_id, path, text); rows that repeat an id and a path are one file."""
    own = materialized(own_licenses(files, weights(files), least), "licenses")
    return inherited(own)


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: by source and ranges of ids; a short text that speaks of a licence is a LICENSE."""
    short = F.coalesce((F.char_length("text") <= 400) & F.regexp_like("text", F.lit(CUE)), F.lit(False))
    name = F.when(short, F.concat(F.lit("LICENSE."), F.col("doc_id"))).otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100), name)
    return docs.select("doc_id", F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
