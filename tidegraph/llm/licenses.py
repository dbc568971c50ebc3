"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a file is compared with every template, and every template with every run
of as many words, wherever lines end; so notices in paragraphs, wrapped headers and whole
licence files are found.  Inverse document frequencies are those of all words over all
files, and the comparison has two steps:

1. A scan that knows the weights of the templates' words alone.  A text can reach the
   threshold only near a template's heavy words, as the rest of its weight is too small;
   there, the dot product is exact, and a word of no template weighs at least 1 and at
   most as one that no file holds, so each cosine lies between two bounds.  What can't
   reach the threshold, or another comparison of the same text, goes.
2. The few comparisons left get the weights of their other words by a join with the
   document frequencies of all words, and the best of each file counts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import map_batches, pick, spread, written

#: Templates by licence: sentences and notices that headers and licence files state (fixed values).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Proprietary": ["All rights reserved"],
}
THRESHOLD = 0.75
_TOKEN = re.compile(r"[a-z0-9]+")
_PLAIN = T._classes(bytes(b for b in range(256) if not (48 <= b <= 57 or 97 <= b <= 122)))
#: (of a line or a run, its place, licence, number of the template, its words, dot product, squared norm of what is known, other words with counts)
FOUND = "array<struct<run:boolean,place:long,name:string,k:int,size:int,dot:double,known:double,words:array<long>,counts:array<long>>>"
_FOUND = pa.list_(
    pa.struct([("run", pa.bool_()), ("place", pa.int64()), ("name", pa.string()), ("k", pa.int32()), ("size", pa.int32()), ("dot", pa.float64()), ("known", pa.float64()), ("words", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
)


def _tokens(line: str) -> list[str]:
    return _TOKEN.findall(line.lower())


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(T.word_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0])


class Scanner:
    """TF-IDF vectors of the templates, and the search for what may be like one."""

    def __init__(self, templates: dict[str, list[str]], n: int, df: dict[str, int], threshold: float, runs: bool = True):
        self.threshold, self.runs = threshold, runs
        self.rare = math.log(1 + n) + 1  # the weight of a word that no file holds
        self.idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for lines in templates.values() for line in lines for w in _tokens(line)}
        self.templates = []  # name, number, words, unit vector
        for name, lines in sorted(templates.items()):
            for k, line in enumerate(lines):
                v = {w: c * self.idf[w] for w, c in Counter(_tokens(line)).items()}
                norm = math.sqrt(sum(x * x for x in v.values()))
                self.templates.append((name, k, sum(Counter(_tokens(line)).values()), {w: x / norm for w, x in v.items()}))
        self.longest = max((t[2] for t in self.templates), default=0)
        self.near: dict[str, list[int]] = defaultdict(list)
        for at, (_, _, _, v) in enumerate(self.templates):
            rest = 1.0
            for w, x in sorted(v.items(), key=lambda wx: (-wx[1], wx[0])):
                if math.sqrt(max(rest, 0)) < threshold - 1e-9:
                    break
                self.near[w].append(at)
                rest -= x * x
        words = "|".join(sorted(self.near, key=lambda w: (-len(w), w)))
        self.heavy = re.compile(rf"(?<![a-z0-9])(?:{words})(?![a-z0-9])".encode())

    def _lines(self, lower: bytes) -> Iterator[tuple]:
        """Comparisons of the lines that hold a heavy word with all templates; the number of a line is its place."""
        at, number, counted = 0, 0, 0
        while m := self.heavy.search(lower, at):
            a = lower.rfind(b"\n", 0, m.start()) + 1
            z = lower.find(b"\n", m.end())
            z = len(lower) if z < 0 else z
            number, counted = number + lower.count(b"\n", counted, a), a
            words = Counter(x.group() for x in _TOKEN.finditer(lower[a:z].decode(errors="replace")))
            known = sum((c * self.idf[w]) ** 2 for w, c in words.items() if w in self.idf)
            other = {w: c for w, c in words.items() if w not in self.idf}
            squares = sum(c * c for c in other.values())
            for name, k, size, t in self.templates:
                dot = sum(words[w] * self.idf[w] * x for w, x in t.items() if w in words)
                if dot:
                    yield False, number, name, k, size, dot, known, squares, other
            at = z

    def _of_runs(self, words: list[str], base: int) -> Iterator[tuple]:
        """Comparisons of each template with the runs of as many words (all, if there are fewer) near its heavy words."""
        spots: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            for at in self.near.get(w, ()):
                spots[at].append(i)
        for at in sorted(spots):
            name, k, size, t = self.templates[at]
            last, done = max(0, len(words) - size), 0
            for i in spots[at]:
                around = t.keys() & set(words[max(0, i - size + 1) : i + size])
                if sum(t[w] * t[w] for w in around) < (self.threshold - 1e-9) ** 2:
                    continue
                first, end = max(done, i - size + 1, 0), min(i, last) + 1
                done = max(done, end)
                count: Counter = Counter()
                dot = known = 0.0
                squares = 0
                for a in range(first, end):
                    changes = [(w, 1) for w in words[a : a + size]] if a == first else [(words[a - 1], -1), (words[a + size - 1], 1)]
                    for w, step in changes:
                        c = count[w]
                        count[w] = c + step
                        if w in self.idf:
                            known += ((c + step) ** 2 - c * c) * self.idf[w] ** 2
                            dot += step * self.idf[w] * t.get(w, 0.0)
                        else:
                            squares += (c + step) ** 2 - c * c
                    if dot > 0:
                        yield True, base + a, name, k, size, dot, known, squares, count

    def text(self, raw: bytes) -> list[dict]:
        """What may be the best comparison of a text."""
        lower = raw.translate(bytes(T.LOWER))
        if not self.heavy.search(lower):
            return []
        held: list[tuple] = []
        floor = self.threshold - 1e-9

        def take(found: Iterator[tuple]) -> None:
            nonlocal floor, held
            for run, place, name, k, size, dot, known, squares, words in found:
                if dot / math.sqrt(known + squares) >= floor - 1e-9:
                    floor = max(floor, dot / math.sqrt(known + squares * self.rare**2))
                    held.append((run, place, name, k, size, dot, known, squares, {w: c for w, c in words.items() if c and w not in self.idf}))
                    if len(held) > 1000:
                        held = [h for h in held if h[5] / math.sqrt(h[6] + h[7]) >= floor - 1e-9]

        take(self._lines(lower))
        if self.runs:
            data = np.frombuffer(lower, np.uint8)
            for piece, starts, ends, _, base in T.cut(data, _PLAIN, self.longest):
                raw_piece = piece.tobytes()
                take(self._of_runs([raw_piece[a:z].decode() for a, z in zip(starts.tolist(), ends.tolist(), strict=True)], base))
        held = [h for h in held if h[5] / math.sqrt(h[6] + h[7]) >= floor - 1e-9]
        return [{"run": h[0], "place": h[1], "name": h[2], "k": h[3], "size": h[4], "dot": h[5], "known": h[6], "words": [_word_hash(w) for w in h[8]], "counts": list(h[8].values())} for h in held]


def frequencies(files: DataFrame) -> DataFrame:
    """(word, n): in how many of the files (text) each word occurs, by its hash; partitions add up before they send."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            h, place = np.unique(np.concatenate([np.empty(0, np.uint64), *(x[0] for x in held)]), return_inverse=True)
            return h, np.bincount(place, np.concatenate([np.empty(0), *(x[1] for x in held)]), minlength=len(h)).astype(np.int64)

        def out(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["word", "n"])

        for b in batches:
            long = defaultdict(list)
            for row, data, starts, ends, first, base in T.pieces(b.column(0), _PLAIN, 0, T.LOWER):
                h = T.word_hashes(data, starts, ends)
                if base is not None:
                    long[row].append(np.unique(h))
                    continue
                rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
                order = np.lexsort((h, rows))
                h, rows = h[order], rows[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
                held.append(np.unique(h[new], return_counts=True))
                size += len(held[-1][0])
            for parts in long.values():
                h = np.unique(np.concatenate(parts))
                held.append((h, np.ones(len(h), np.int64)))
                size += len(h)
            if size > 4_000_000:
                held = [added()]
                size = len(held[0][0])
            if size > 2_000_000:
                yield out(*added())
                held, size = [], 0
        if held:
            yield out(*added())

    return map_batches(spread(files.select("text")), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD, runs: bool = False) -> DataFrame:
    """path, own_license, similarity of every row of files (path, text); null and 0 if nothing reaches the threshold.

    Compared are lines, and with `runs` also runs of words within and across lines.  The
    largest cosine counts; of equal ones (to nine places) the longer template, lines
    before runs, the first place, the first name.
    """
    rows = pick(files, "path", "text")
    df = written(frequencies(rows), "frequencies")
    vocabulary = {_word_hash(w): w for lines in templates.values() for line in lines for w in _tokens(line)}
    n = rows.count()
    known = {vocabulary[r["word"]]: r["n"] for r in df.where(F.col("word").isin(list(vocabulary))).collect()}  # one row a template word
    shared = rows.sparkSession.sparkContext.broadcast(Scanner(templates, n, known, threshold, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.text(t.as_py() or b"") for t in b.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _FOUND)], names=["path", "found"])

    scanned = written(map_batches(spread(rows), run, f"path string, found {FOUND}").withColumn("__row", F.monotonically_increasing_id()), "scanned")
    some = scanned.where(F.size("found") > 0).select("__row", F.posexplode("found").alias("at", "c")).select("__row", "at", "c.*")
    words = some.select("__row", "at", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("__row", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("count"))
    idf = F.log((1.0 + n) / (1.0 + F.coalesce("n", F.lit(0)))) + 1
    others = words.join(df, "word", "left").groupBy("__row", "at").agg(F.sum((F.col("count") * idf) ** 2).alias("others"))
    cosine = F.col("dot") / F.sqrt(F.col("known") + F.coalesce("others", F.lit(0.0)))
    scored = some.drop("words", "counts").join(others, ["__row", "at"], "left").withColumn("similarity", cosine).where(F.col("similarity") >= threshold)
    order = F.struct(-F.round("similarity", 9), -F.col("size"), "run", "place", "name", "k")
    best = written(scored.groupBy("__row").agg(F.min_by(F.struct("name", "similarity"), order).alias("best")), "best")
    return scanned.select("__row", "path").join(best, "__row", "left").select("path", F.col("best.name").alias("own_license"), F.coalesce("best.similarity", F.lit(0.0)).alias("similarity"))


#: Names of files whose licence holds for their directory.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([._-][^/]*)?$"


def inherit(scanned: DataFrame, licence_files: str = LICENCE_FILE) -> DataFrame:
    """path, own_license, similarity, license, inherited_from: a file without a licence takes the nearest ancestor directory's.

    A directory's licence is that of its licence file (of several the smallest path).  The
    join is by path: each directory that holds files is joined with its ancestors, so what
    is exploded is directories, not files, and depth bounds it.
    """
    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    rows = scanned.withColumn("dir", directory)
    licensed = rows.where(F.col("path").rlike(licence_files) & F.col("own_license").isNotNull()).groupBy("dir").agg(F.min(F.struct("path", "own_license")).alias("of"))
    parts = F.split("dir", "/")
    above = rows.select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts)))).withColumn("up", F.when(F.col("depth") == 0, "").otherwise(F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")))
    nearest = above.join(licensed.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "of")).alias("near"))
    # written, so that Spark knows how few directories there are and sends them to all files
    return rows.join(written(nearest, "nearest"), "dir", "left").select(
        "path",
        "own_license",
        "similarity",
        F.coalesce("own_license", "near.of.own_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("near.of.path")).alias("inherited_from"),
    )


def license_scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD, licence_files: str = LICENCE_FILE) -> DataFrame:
    """scan, with runs of words, and inherit over files (path, text).

    Null and empty texts have no licence of their own (similarity 0) but inherit; rows
    without a path keep their own licence and inherit nothing; repeated rows stay repeated;
    of equally near licence files the smallest path counts; an empty table gives an empty
    result.
    """
    return inherit(written(scan(files, templates, threshold, runs=True), "licenses"), licence_files)
