"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

from tests.llm import brute
from tests.parity import compare, duck
from tidegraph.llm import decontaminate, langid, licenses, nearest, queries


def test_contamination_of_many_parts_keeps_null_and_repeated_ids(spark):
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(words[i : i + 15])) for i in range(40)]
    rows = [(1, " ".join(words[:20])), (1, " ".join(words[30:50])), (1, " ".join(words[:20])), (None, " ".join(words[5:40])), (None, "none of it"), (None, None), (2, "w1 w2"), (3, " ".join(["x"] * 400 + words[40:53]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.contamination(list(enumerate(t for _, t in rows)), items)
    expected = sorted([(d, *expected[i]) for i, (d, _) in enumerate(rows)], key=str)
    for most in (decontaminate.MOST_BYTES, 300):
        assert sorted([tuple(r) for r in decontaminate.contamination(docs, bench, most_bytes=most).collect()], key=str) == expected
    assert any(x[0] is None and x[-1] for x in expected) and len(list(decontaminate._parts(bench, 300))) > 2


MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
)
SENTENCE = "This file is part of the project and is released under the MIT License, see LICENSE for details."
WRAPPED = "/*\n * This program is free software: you can\n * redistribute it and/or modify it under\n * the terms of the GNU General\n * Public License as published\n */\nint main() { return 0; }"
BSD = "Copyright (c) 2001, A. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that"


def test_licences_in_long_and_wrapped_lines(spark):
    rows = [("m/LICENSE", MIT), ("m/a.py", "code"), ("s/b.py", SENTENCE), ("g/c.c", WRAPPED), ("b/COPYING", BSD), ("b/d.c", "x"), ("n/e.txt", "the program is free and may not use the file except under the work of all"), ("n/f.txt", " ".join(["word"] * 500))]
    rows += [(f"z/{i}.txt", f"filler number {i} of the text") for i in range(200)]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: (r.own_license, r.license) for r in licenses.license_scan(files).collect() if not r.path.startswith("z/")}
    assert found == {
        "m/LICENSE": ("MIT", "MIT"), "m/a.py": (None, "MIT"), "s/b.py": ("MIT", "MIT"), "g/c.c": ("GPL-3.0", "GPL-3.0"), "b/COPYING": ("BSD-3-Clause", "BSD-3-Clause"),
        "b/d.c": (None, "BSD-3-Clause"), "n/e.txt": (None, None), "n/f.txt": (None, None),
    }


def test_lettered_documents_stay_if_no_language_is_learnt(spark):
    rows = [(1, "some text", None), (2, "12 34", None), (3, None, None), (4, "\u4e2d\u6587", None), (None, "more", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(str(r.doc_id) for r in langid.with_language(docs).collect()) == ["1", "4", "None"]


def test_least_coverage_lets_the_filters_decide(spark):
    rows = [(i, "the quick brown fox and the lazy dog of the town", "en") for i in range(40)] + [(100, "zxqv kjwp vvqz xkcd", None), (101, "77", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [{r.doc_id for r in langid.with_language(docs, least).collect()} for least in (0.0, 0.2)]
    assert 100 in kept[0] and kept[0] - kept[1] == {100} and 101 not in kept[0]


def test_nearest_keeps_different_vectors_of_one_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [5.0, 1.0]), (1, [1.0, 7.0]), (2, [2.0, 2.5]), (3, [4.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    pairs = sorted((-(a * x + b * y), c) for q, (a, b) in rows if q == 0 for c, (x, y) in rows if c != 0)
    for k, block in ((3, None), (20, 2)):
        found = sorted((r.rank, r.vec_id, r.score) for r in nearest.nearest(df, k=k, block=block).collect())
        assert found == [(i + 1, c, -s) for i, (s, c) in enumerate(pairs[:k])]


def test_license_query_inherits_from_both_levels(spark, medium):
    found = queries.QUERIES["op4_license_ancestors"](spark, medium).cache()
    compare(found, duck(medium), queries.ORACLE_SQL["op4_license_ancestors"])
    depths = {(r.path.count("/"), r.inherited_from.count("/")) for r in found.where("inherited_from is not null").collect()}
    assert {(3, 1), (3, 3)} <= depths
