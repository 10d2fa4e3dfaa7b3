import math
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from docketmill.llm import licenses as L


def brute(files):
    """Own licence of every (path, text), by plain TF-IDF vectors."""
    n = len(files)
    held = [set(re.findall(L.TERM, (t or "").lower())) for _, _, t in files]
    vocabulary = {w for texts in L.TEMPLATES.values() for t in texts for w in re.findall(L.TERM, t.lower())}
    idf = {w: math.log((1 + n) / (1 + sum(w in h for h in held))) + 1 for w in vocabulary}

    def vector(text):
        words = re.findall(L.TERM, text.lower())
        return {w: words.count(w) * idf.get(w, math.log(1 + n) + 1) for w in set(words)}

    def cosine(a, b):
        norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return round(sum(v * b.get(w, 0) for w, v in a.items()) / norm, 9) if norm else 0.0

    own = {}
    for doc_id, path, text in files:
        paragraphs = regex.split(r"\n[^\p{L}\p{N}]*\n", text or "")
        lines = [s for s in (text or "").split("\n") + paragraphs if re.search(L.CUE, s)]
        if lines and path and re.match(L.FILE_NAME, path.split("/")[-1]):
            lines.append(text)
        best = min(((-cosine(vector(s), vector(t)), name) for s in lines
                    for name, texts in L.TEMPLATES.items() for t in texts), default=(0, None))
        own[doc_id, path] = (-best[0], best[1]) if -best[0] >= L.LEAST_COSINE else (None, None)
    return own


def inherit(own):
    by_dir = {}
    for (_, path), (cosine, name) in own.items():
        if path and name and re.match(L.FILE_NAME, path.split("/")[-1]):
            by_dir.setdefault(path.rpartition("/")[0], []).append((-cosine, path, name))
    found = {}
    for (doc_id, path), (cosine, name) in own.items():
        is_file = bool(path) and bool(re.match(L.FILE_NAME, path.split("/")[-1]))
        origin = "none"
        if name:
            origin = "file" if is_file else "header"
        elif path:
            at = path
            while at and origin == "none":
                at = at.rpartition("/")[0]
                if at in by_dir:
                    name, origin = min(by_dir[at])[2], "directory"
        found[doc_id, path] = (name, origin)
    return found


FILES = [
    (1, "a/LICENSE", "MIT License\n\nReleased under the MIT License."), (2, "a/b/c/x.py", "print(1)"),
    (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."), (4, "a/y.py", ""), (5, "top.py", None),
    (6, "z/COPYING", "all rights reserved by the licensee of the day"), (7, "z/q.py", "x = 1"),
    (8, "a/b/h.py", "# This work is licensed under the GNU General Public License, version 3.\ncode"),
    (9, None, "Released under the MIT License."), (10, None, "nothing"), (11, "a/b/LICENSE-mit", "Released under the MIT License."),
    (12, "w/lots.txt", "words without end " * 5000 + "\nlicense"), (2, "a/b/c/x.py", "print(1)"),
]


def check(spark, files):
    docs = spark.createDataFrame(files, "doc_id bigint, path string, text string")
    own = brute(files)
    expected = inherit(own)
    rows = L.scan(docs).collect()
    assert {(r["doc_id"], r["path"]) for r in rows} == expected.keys() and len(rows) == len(expected)
    for r in rows:
        key = r["doc_id"], r["path"]
        assert (r["license"], r["origin"]) == expected[key], key
        assert r["own_license"] == own[key][1]
        assert (r["cosine"] is None) == (own[key][0] is None) and (
            r["cosine"] is None or r["cosine"] == pytest.approx(own[key][0], abs=1e-8))
    return expected


def test_files_against_brute_force(spark):
    found = check(spark, FILES)
    assert found[2, "a/b/c/x.py"][1] == "directory" and found[4, "a/y.py"] == ("MIT", "directory")
    assert found[7, "z/q.py"] == (None, "none")


HEADERS = {
    "MPL-2.0": "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not"
               " distributed with this\n# file, You can obtain one at http://mozilla.org/MPL/2.0/.\n",
    "GPL-3.0": " * This program is free software: you can redistribute it and/or modify\r\n * it under the terms of the GNU General Public"
               " License as published by\r\n * the Free Software Foundation, either version 3 of the License, or\r\n * (at your option)"
               " any later version.\r\n *\r\n * It is distributed in the hope that it will be useful.\r\n",
    "Apache-2.0": "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with"
                  " the License.\n// You may obtain a copy of the License at\n//\n//     http://www.apache.org/licenses/LICENSE-2.0\n",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation"
           " files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use,"
           " copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the"
           " Software is\nfurnished to do so, subject to the following conditions:\n",
    "BSD-3-Clause": "# Use of this source code is governed by a BSD-style\n# license that can be found in the LICENSE file.\n",
}


@pytest.mark.parametrize("name", HEADERS)
def test_wrapped_headers_are_found(spark, name):
    code = "\n\nint main() { return 0; }\n" * 20
    files = [(i, f"src/{i}.c", "#!/bin/x\n\n" + HEADERS[name] + "\n" + code) for i in range(2)]
    files += [(i, f"other/{i}.c", code + f"// number {i} of other words in this place") for i in range(2, 40)]
    rows = L.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in rows} == {i: name if i < 2 else None for i in range(40)}


def test_a_long_line_with_a_cue_takes_seconds(spark):
    words = " ".join(f"word{i % 7000}" for i in range(60_000))
    blanks = "license\n" + "\n * \n" * 50_000 + "Released under the MIT License."
    files = [(1, "a/x.txt", words + " license " + words), (2, "a/LICENSE", words + " license"), (3, "b/y.txt", blanks)]
    start = time.monotonic()
    rows = L.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()
    assert time.monotonic() - start < 60
    assert {r["doc_id"]: r["license"] for r in rows} == {1: None, 2: None, 3: "MIT"}


def test_licence_file_at_the_top(spark):
    check(spark, [(1, "LICENSE", "Released under the MIT License."), (2, "a/b.py", "x"), (3, "c.py", "y")])


def test_documents_against_brute_force(spark):
    docs = L.document_files(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = check(spark, [tuple(r) for r in docs.collect()])
    assert {"file", "header", "directory", "none"} == {origin for _, origin in found.values()}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = L.scan(L.document_files(odd_docs)).collect()
    assert len(rows) == odd_docs.select("doc_id").distinct().count()
    assert {r["origin"] for r in rows} == {"none"}
    assert L.scan(L.document_files(no_docs)).collect() == []
    with_columns = spark.createDataFrame([(1, "LICENSE", "Released under the MIT License.", 1.0)],
                                         "doc_id bigint, path string, text string, cosine double")
    assert L.scan(with_columns.select("doc_id", "path", "text", F.col("cosine"))).first()["license"] == "MIT"
