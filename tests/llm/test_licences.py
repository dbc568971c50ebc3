"""Licence scans against every line and every run compared with every template, under the weights of all words."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidegraph.llm import licenses, queries
from tidegraph.llm import text as T

TEMPLATES = [(name, k, licenses._tokens(line)) for name, lines in licenses.TEMPLATES.items() for k, line in enumerate(lines)]


def tokens(text: str) -> list[str]:
    """Words of ASCII letters and digits; only A-Z are lower-cased."""
    return licenses._TOKEN.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def plain(texts: list[str | None], runs: bool) -> list[tuple[str | None, float]]:
    df = Counter(w for t in texts for w in set(tokens(t or "")))
    weight = lambda w: math.log((1 + len(texts)) / (1 + df[w])) + 1

    def vector(words):
        return {w: c * weight(w) for w, c in Counter(words).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0.0) for w, x in a.items()) / norm if norm else 0.0

    of = [(name, k, len(words), vector(words)) for name, k, words in TEMPLATES]
    out = []
    for text in texts:
        found = []
        for i, line in enumerate((text or "").split("\n")):
            v = vector(tokens(line))
            found += [(cosine(v, t), size, False, i, name, k) for name, k, size, t in of]
        words = tokens(text or "")
        for name, k, size, t in of if runs else []:
            found += [(cosine(vector(words[a : a + size]), t), size, True, a, name, k) for a in range(max(0, len(words) - size) + 1)]
        best = min(found, key=lambda x: (-round(x[0], 9), -x[1], *x[2:]))
        out.append((best[4], best[0]) if best[0] >= licenses.THRESHOLD else (None, 0.0))
    return out


def sample() -> list[str | None]:
    rng = random.Random(5)
    fill = [f"word{i}" for i in range(300)] + ["the", "license", "software", "all", "rights", "free", "É", "copy"]
    texts: list[str | None] = [None, "", "the license is free", "ALL RIGHTS RESERVED", "All rights reserved.\nReleased under the MIT License"]
    for _ in range(120):
        _, _, words = rng.choice(TEMPLATES)
        words = [w for w in words if rng.random() < rng.choice([1.0, 0.95, 0.8])]
        for _ in range(rng.choice([0, 0, 3])):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fill))
        around = [" ".join(rng.choices(fill, k=rng.randrange(12))) for _ in range(2)]
        gap = rng.choice(["\n", " ", ". "])
        cut = rng.randrange(len(words) + 1)
        body = " ".join(words) if rng.random() < 0.6 else " ".join(words[:cut]) + "\n * " + " ".join(words[cut:])
        texts.append(around[0] + gap + body.title() + gap + around[1])
    return texts + [" ".join(rng.choices(fill, k=40)) for _ in range(60)]


@pytest.mark.parametrize("runs", [False, True])
def test_scan_equals_all_comparisons(spark, runs):
    texts = sample()
    files = spark.createDataFrame([(f"d/{i}", t) for i, t in enumerate(texts)], "path string, text string").repartition(3)
    found = {r.path: (r.own_license, r.similarity) for r in licenses.scan(files, runs=runs).collect()}
    expected = plain(texts, runs)
    assert sum(x[0] is not None for x in expected) > 40
    for i, (name, cosine) in enumerate(expected):
        assert found[f"d/{i}"][0] == name, texts[i]
        assert abs(found[f"d/{i}"][1] - cosine) < 1e-9


def test_frequencies_count_every_word_once_a_file(spark, monkeypatch):
    texts = [*sample(), " ".join(f"long{i % 5000}" for i in range(60_000))]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found = {r.word: r.n for r in licenses.frequencies(df).collect()}
    expected = Counter(w for t in texts for w in set(tokens(t or "")))
    assert found == {licenses._word_hash(w): n for w, n in expected.items()}


def test_a_file_like_none_costs_a_search_alone():
    scanner = licenses.Scanner(licenses.TEMPLATES, 1000, {}, licenses.THRESHOLD)
    assert scanner.text(b"a text of other words " * 1000) == [] and scanner.text(b"") == []
    assert all(c["dot"] for c in scanner.text(b"x\nreleased under the mit license\n"))


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    scanner = licenses.Scanner(licenses.TEMPLATES, 1000, {}, licenses.THRESHOLD)
    text = ("filler words of a text\n" * 30 + " ".join(licenses.TEMPLATES["MIT"][2].split()) + "\n" + "more words " * 90).encode()
    whole = scanner.text(text)
    monkeypatch.setattr(T, "PIECE", 150)
    same = lambda found: {(c["run"], c["place"], c["name"], c["k"], round(c["dot"], 9)) for c in found}
    assert same(scanner.text(text)) == same(whole) and any(c["run"] for c in whole)


MIT_FILE = "MIT License\n\nCopyright (c) 2001 Someone\n\n" + licenses.TEMPLATES["MIT"][2].replace(", ", ",\n") + ":\n\nThe above copyright notice and this permission notice shall be included in all copies."
BSD_FILE = "Copyright (c) 2001, A.\nAll rights reserved.\n\n" + licenses.TEMPLATES["BSD-3-Clause"][1].replace(" that", "\nthat")
APACHE_HEADER = "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\nimport os\n"


def test_pasted_files_and_wrapped_headers(spark):
    rows = [("m/LICENSE", MIT_FILE), ("m/x/y/a.py", "import os"), ("b/COPYING", BSD_FILE), ("b/c.c", None), ("a/h.py", APACHE_HEADER), ("a/n.py", "x"), ("LICENSE.md", licenses.TEMPLATES["ISC"][0]), ("top.txt", "")]
    rows += [(f"z/{i}.txt", f"filler number {i} of the text with other words") for i in range(300)]
    found = {r.path: (r.own_license, r.license, r.inherited_from) for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: found[p] for p, _ in rows[:8]} == {
        "m/LICENSE": ("MIT", "MIT", None), "m/x/y/a.py": (None, "MIT", "m/LICENSE"), "b/COPYING": ("BSD-3-Clause", "BSD-3-Clause", None), "b/c.c": (None, "BSD-3-Clause", "b/COPYING"),
        "a/h.py": ("Apache-2.0", "Apache-2.0", None), "a/n.py": (None, "ISC", "LICENSE.md"), "LICENSE.md": ("ISC", "ISC", None), "top.txt": (None, "ISC", "LICENSE.md"),
    }
    assert {found[f"z/{i}.txt"] for i in range(300)} == {(None, "ISC", "LICENSE.md")}


def test_repeated_rows_and_rows_without_path(spark):
    mit = "Released under the MIT License"
    rows = [("a/b", mit), ("a/b", mit), (None, mit), (None, None), ("a/LICENSE", mit)]
    df = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "1 as __row", "2 as found", "'x' as PATH")
    assert sorted((str(r.path), str(r.own_license)) for r in licenses.scan(df).collect()) == sorted((str(p), "MIT" if t else "None") for p, t in rows)
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).collect() == []


def test_query_has_no_notice_that_only_a_run_finds(spark, medium):
    found = queries.op4_license_scan(spark, medium).select("doc_id", "own_license").toPandas()
    texts = pa.table(spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").toPandas()).to_pylist()
    assert np.sum(found["own_license"].notna()) > 5 and len(found) == len(texts)
