"""Chat formatting and license scans."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import pytest
from helpers import DOCS, no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inboxlens.llm import chat, licenses
from tools.compare import rows_of as counted

SMALL = "/root/testdata/sf0.001"
TREE = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def formatted(turns):
    def escape(text):
        for plain, written in chat.ESCAPES:
            text = text.replace(plain, written)
        return text

    return "".join(f"{chat.OPEN}{escape(r)}>{escape(t)}{chat.CLOSE}" for r, t in turns)


def test_statement(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    df = chat.query(spark, SMALL)
    result = db.execute(chat.SQL)
    columns = [c[0] for c in result.description]
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(columns, result.fetchall())
    probe = df.filter("conv_id = -7").first()
    assert probe["loss_sha256"] == hashlib.sha256(chat.PROBE.encode()).hexdigest()


def test_branches_by_score(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 5.0),
        (1, 4, 2, "user", "c", 9.0),
        (1, 5, 3, "user", None, None),
        (1, 6, 3, "user", "tie", 0.0),
        (2, 1, 99, "user", "orphan", 0.0),
        (None, 1, None, None, "nameless", 0.0),
        (3, None, None, "user", "left out", 0.0),
        (2, 1, 99, "user", "orphan", 0.0),
    ]
    df = chat.conversations(spark.createDataFrame(rows, TREE).selectExpr("*", "1 AS leaf", "2 AS t"), branches=2)
    got = {(r["tree"], r["branch"]): (r["leaf"], r["formatted"]) for r in df.collect()}
    assert got == {
        (1, 1): (4, formatted([("user", "root"), ("assistant", "a"), ("user", "c")])),
        (1, 2): (5, formatted([("user", "root"), ("assistant", "b"), ("user", "")])),
        (2, 1): (1, formatted([("user", "orphan")])),
        (None, 1): (1, formatted([("", "nameless")])),
    }


def test_paths_against_a_walk(spark):
    import random

    rng = random.Random(4)
    parent = {k: rng.choice([k - 1, rng.randrange(k)]) if k else None for k in range(150)}
    rows = [(7, k, p, "user", str(k), 0.0) for k, p in parent.items()]
    got = {}
    for r in chat.paths(spark.createDataFrame(rows, TREE)).collect():
        got.setdefault(r["leaf"], {})[r["up"]] = r["node"]
    want = {}
    for leaf in set(parent) - set(parent.values()):
        at, line = leaf, []
        while at is not None:
            line.append(at)
            at = parent[at]
        want[leaf] = dict(enumerate(line))
    assert got == want


@pytest.mark.parametrize("branches", [1, 3, 1000])
def test_best_branches_against_a_walk(spark, branches):
    import random

    rng = random.Random(9)
    rows, want = [], {}
    for tree, size, near in ((1, 90, 0.9), (2, 60, 0.2), (3, 1, 0.0)):
        parent = {k: (k - 1 if rng.random() < near else rng.randrange(k)) if k else None for k in range(size)}
        score = {k: rng.choice([None, float(rng.randrange(8))]) for k in parent}
        rows += [(tree, k, p, "user", str(k), score[k]) for k, p in parent.items()]
        leaves = []
        for leaf in set(parent) - set(parent.values()):
            line = [leaf]
            while parent[line[-1]] is not None:
                line.append(parent[line[-1]])
            leaves.append((-sum(score[k] or 0 for k in line) / len(line), leaf, line[::-1]))
        for nth, (_, leaf, line) in enumerate(sorted(leaves)[:branches], 1):
            want[tree, nth] = (leaf, formatted([("user", str(k)) for k in line]))
    df = chat.conversations(spark.createDataFrame(rows, TREE), branches=branches)
    assert {(r["tree"], r["branch"]): (r["leaf"], r["formatted"]) for r in df.collect()} == want


def test_circles_are_refused(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)]
    with pytest.raises(ValueError):
        chat.conversations(spark.createDataFrame(rows, TREE))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a>b\\"]), st.text("\\<>blg/turn:é\n ", max_size=25)), min_size=1, max_size=30))
def test_reading_back_is_exact(spark, turns):
    rows = [(1, k, k - 1 if k else None, r, t, 0.0) for k, (r, t) in enumerate(turns)]
    df = chat.conversations(spark.createDataFrame(rows, TREE)).select(
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("under"),
    )
    row = df.first()
    assert row["formatted"] == formatted(turns)
    assert [tuple(t) for t in row["turns"]] == turns
    assert row["under"] == "".join(t for r, t in turns if r == "assistant")


def test_empty_trees(spark):
    assert chat.conversations(spark.createDataFrame([], TREE)).count() == 0


def test_ties_in_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (1, 0, "user", "a")]
    turns = chat.from_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert chat.conversations(turns).first()["formatted"] == formatted([("", ""), ("user", "a"), ("user", "a"), ("user", "b")])


def test_native_plans(spark, plan_of):
    turns = chat.from_turns(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    for df in (chat.conversations(turns), licenses.query(spark, SMALL)):
        assert not any(w in plan_of(df) for w in ("Python", "Arrow", "Pandas", "Cartesian"))


def brute_licenses(files):
    """License of every file by the same rules, in plain Python."""
    def terms(text):
        found = [re.sub(r"^[.\-]+|[.\-]+$", "", w) for w in re.split(r"[^\w.\-]+", text.lower().replace("_", " "))]
        return [w for w in found if w]

    notices = {}
    for path, text in files.items():
        lines = [l for l in (text or "").split("\n") if re.search(licenses.NOTICE, l.lower())]
        if lines:
            own, size = len("\n".join(lines).split()), len((text or "").split())
            name = path.split("/")[-1].lower()
            whole = own >= licenses.WHOLE_FILE * size or bool(re.match(r"(licen[sc]e|copying|notice)(\.|$)", name))
            notices[path] = (terms("\n".join(lines)), whole)
    templates = [(f"{n} {k}", terms(t)) for k, (n, t) in enumerate(licenses.TEMPLATES)]
    df = Counter()
    for words in [w for w, _ in notices.values()] + [w for _, w in templates]:
        df.update(set(words))
    total = len(notices) + len(templates)

    def vector(words):
        v = {w: (1 + math.log(n)) * (math.log((total + 1) / (df[w] + 1)) + 1) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    own, marked = {}, {}
    for path, (words, whole) in notices.items():
        v = vector(words)
        scores = sorted(
            (-round(sum(x * other.get(w, 0) for w, x in v.items()), 6), name)
            for name, other in ((n, vector(w)) for n, w in templates)
        )
        if scores and -scores[0][0] >= licenses.THRESHOLD:
            own[path] = (scores[0][1].split(" ")[0], -scores[0][0])
            if whole:
                where = "/".join(path.split("/")[:-1])
                marked[where] = min(marked.get(where, (0, "")), (scores[0][0], path, own[path][0]))
    out = {}
    for path in files:
        if path in own:
            out[path] = (own[path][0], None)
            continue
        parts = path.split("/")[:-1]
        out[path] = (None, None)
        for n in range(len(parts), -1, -1):
            where = "/".join(parts[:n])
            if where in marked:
                out[path] = (marked[where][2], where)
                break
    return out


def test_scan_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = brute_licenses({f"{r['source']}/{r['lang']}/{r['doc_id']}": r["text"] for r in docs})
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in licenses.query(spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    assert {"MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"} <= {l for l, _ in want.values()}


def test_license_statement(spark):
    db = duckdb.connect()
    db.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    df = licenses.query(spark, "/root/testdata/sf0.01")
    result = db.execute(licenses.SQL)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(columns, result.fetchall())


def test_nearest_directory_wins(spark):
    files = [
        ("LICENSE", "Released under the MIT License."),
        ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/code.py", "x = 1"),
        ("a/code.py", "y = 2"),
        ("a/b/own.py", "z = 3\nThis work is licensed under the GNU General Public License, version 3."),
        ("code.py", None),
        (None, "Released under the MIT License."),
        (None, "nothing"),
        ("a/code.py", "y = 2"),
        ("a/b/word", "a licence to talk about it at length, more words than a notice has"),
    ]
    df = spark.createDataFrame(files, "path string, text string").selectExpr("*", "'x' AS license", "1 AS dir", "2 AS key")
    got = sorted(((r["path"], r["_license"], r["inherited_from"]) for r in licenses.scan(df).collect()), key=repr)
    assert got == sorted(
        [
            ("LICENSE", "MIT", None),
            ("a/b/COPYING", "Apache-2.0", None),
            ("a/b/c/code.py", "Apache-2.0", "a/b"),
            ("a/code.py", "MIT", ""),
            ("a/b/own.py", "GPL-3.0", None),
            ("code.py", "MIT", ""),
            (None, "MIT", None),
            (None, None, None),
            ("a/code.py", "MIT", ""),
            ("a/b/word", "Apache-2.0", "a/b"),
        ],
        key=repr,
    )


def test_odd_files(spark):
    docs = odd_documents(spark, extra=True).withColumnRenamed("lang", "path")
    assert licenses.scan(docs).count() == docs.count()
    empty = spark.createDataFrame([], DOCS).withColumnRenamed("lang", "path")
    assert licenses.scan(empty).count() == 0
    assert no_documents(spark).count() == 0


MIT_FILE = """MIT License

Copyright (c) 2021 Acme Inc

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_headers_and_whole_texts(spark):
    code = "\n".join(f"def f{k}(x): return x + {k}" for k in range(30))
    files = {
        "p/mit.py": ("# Copyright (c) 2021 Acme Inc\n# Licensed under the MIT License.\n" + code, "MIT"),
        "p/names.py": ("".join(f"# Copyright {n} Person{n} Surname{n}\n" for n in range(9))
                       + "# Licensed under the Apache License, Version 2.0.\n" + code, "Apache-2.0"),
        "p/one_line.py": ("# Part of Tool 7. Released under the MIT License. See the manual of Tool 7.\n" + code, "MIT"),
        "p/reserved.c": ("/* Copyright 2020 Acme. All rights reserved.\n * Licensed under MIT License */\n" + code, "MIT"),
        "p/bsd.c": ("/*\n * Copyright (c) 2019 Foo Bar. All rights reserved.\n *\n * Redistribution and use in source and binary "
                    "forms, with or without\n * modification, are permitted provided that the following\n * conditions are met:\n"
                    " */\n" + code, "BSD-3-Clause"),
        "p/plain.c": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files\n" + code, "MIT"),
        "p/agpl.c": ("// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU "
                     "Affero General Public License as\n// published by the Free Software Foundation, either version 3 of the\n"
                     "// License, or (at your option) any later version.\n" + code, "AGPL-3.0"),
        "q/LICENSE": (MIT_FILE, "MIT"),
        "q/mit.txt": (MIT_FILE, "MIT"),
        "r/texts/mit": (MIT_FILE, "MIT"),
        "r/texts/code": (code, "MIT"),
        "s/code": (code + "\n# the copyright of names and the license to use them is a long story", None),
    }
    df = spark.createDataFrame([(p, t) for p, (t, _) in files.items()], "path string, text string")
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in licenses.scan(df).collect()}
    assert got == {p: (l, "r/texts" if p == "r/texts/code" else None) for p, (_, l) in files.items()}
