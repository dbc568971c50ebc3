from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tidegraph.llm import decontaminate, langid, licenses, nearest, packing, quality, queries, shared, simhash, substring, token_counts, token_files, tokens

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark, medium):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows():
    """Nulls, empty, very long, repeated and equal rows, odd white space, marks of special tokens."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(words[100:170])
    long = " ".join(rng.choice(words) for _ in range(60_000))
    texts = [None, "", " ", "  \n\t ", "a", "!!! 123", "É", "one two", passage, "x " + passage + " y", passage + "\n" + passage, long, long + " tail"]
    texts += ["a b c  d\n\n\ne \n f", "<|endoftext|> x<|endoftext|>y <|startoftext|>", "tab\tand\rreturn\x0b\x1cq", "it's they'll 'S", "中文 字符　x", "náive Café"]
    texts += ["ha " * 200, "ha " * 200, "word" * 300]
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, "no id " + passage, "en", "s", 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), DOCS)
    # extra columns whose names clash with the operators' own or differ in case only
    return df.selectExpr("*", "1 as print", "2 as component_id", "'q' as TEXT", "3 as __of", "4 as lang_pred")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# nearest neighbours


def exact(vectors, k, every=20):
    out = {}
    for q, x in vectors:
        if q % every == 0:
            found = sorted((-float(np.dot(np.float64(x), np.float64(y))), c) for c, y in vectors if c != q and len(x) == len(y))
            out[q] = [(c, -s) for s, c in found[:k]]
    return out


def check_nearest(result, expected):
    got = defaultdict(list)
    for q, r, v, s in sorted(rows_of(result, "query_id", "rank", "vec_id", "score")):
        assert r == len(got[q]) + 1
        got[q].append((v, s))
    assert {q for q, v in expected.items() if v} == set(got)
    for q, v in got.items():
        assert [a for a, _ in v] == [a for a, _ in expected[q]]
        np.testing.assert_allclose([b for _, b in v], [b for _, b in expected[q]], rtol=1e-12, atol=1e-12)


def test_nearest_equals_brute_force(spark, medium):
    table = spark.read.parquet(f"{medium}/embeddings.parquet")
    check_nearest(queries.op1_nearest_neighbours(spark, medium), exact([(r.vec_id, r.embedding) for r in table.collect()], 20))


def test_nearest_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [float("inf"), 1.0]), (20, [-1.0, 0.5]), (21, [1.0, 2.0, 3.0]), (40, [9.0, 9.0, 1.0]), (None, [1.0, 1.0]), (60, []), (1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as tile", "2 as VECTOR")
    usable = [(0, [1, 2]), (1, [1, 2]), (2, [1, 2]), (20, [-1, 0.5]), (21, [1, 2, 3]), (40, [9, 9, 1])]
    for block in (None, 2):
        check_nearest(nearest.nearest(df, k=2, block=block), exact(usable, 2))
    assert nearest.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_nearest_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 else [float(i % 7), 2.0, -1.0]) for i in range(900)]
    check_nearest(nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=100), exact(rows, 20))


# languages


def test_languages_of_held_out_rows(spark, medium):
    found = {r.doc_id: r for r in queries.op2_language_id(spark, medium).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    held = [d for d, r in found.items() if r.held_out]
    assert len(found) == len(truth) and 0.2 < len(held) / len(truth) < 0.3
    assert np.mean([found[d].lang_pred == truth[d] for d in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_filters_hold_every_kept_gram(spark, medium):
    model = langid.learn(spark.read.parquet(f"{medium}/documents.parquet"))
    assert set(model.langs) == {"en", "de", "fr", "es"}
    assert (model.false < 0.01).all()


def test_languages_odd_rows(spark, odd, none):
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_id(odd).collect()}
    assert all(found[i] == ("und", 0.0) for i in (0, 1, 2, 3, 5))
    assert all(found[i][0] == "en" for i in (4, 6, 7, 8, 11))
    assert langid.language_id(none).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.language_id(unlabelled).collect()] == ["und"]
    kept = langid.with_language(odd)
    assert kept.columns == odd.columns
    assert {0, 1, 2, 3, 5}.isdisjoint(r[0] for r in kept.collect())


# tokens


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(vocabulary):
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'s", "'", "É", "ö", "é", "<|endoftext|>", "<|startoftext|>", "<|", "1", "23", "!!", " ", " ", "中文", "😀", "\x1c", "\x85", "​", "İ", "Σ", ".", " the", "\n ", "x", "'LL", "?!,", "Straße", "﻿"]
    encoder = tokens.Encoder(tokens.path(vocabulary))
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, encoder.dtype).tolist() == brute.ids(vocabulary, text)


def test_counts(spark, medium, docs, odd, none):
    expected = {d: (len(t.encode()), n := len(brute.ids("byte_bpe_50k.json", t)), n > 512) for d, t in docs}
    found = {r[0]: r[1:] for r in rows_of(queries.op5_token_counts(spark, medium), "doc_id", "n_bytes", "n_tokens", "over_limit")}
    assert found == expected
    got = sorted(rows_of(token_counts.token_counts(odd), "n_bytes", "n_tokens"))
    assert got == sorted((len((t or "").encode()), len(brute.ids("byte_bpe_50k.json", t))) for _, t, *_ in odd_rows())
    assert token_counts.token_counts(none).collect() == []


def check_files(found, texts):
    at, expected = 0, []
    for d, t in texts:
        ids = brute.ids("word_bpe_49k.json", t, 1)
        expected.append((d, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected


def test_token_files(spark, medium, docs, monkeypatch):
    check_files(rows_of(queries.op3_token_files(spark, medium), "doc_id", "start", "n_tokens", "ids_crc32"), sorted(docs))
    monkeypatch.setattr(token_files, "SHARD_BYTES", 300_000)
    check_files(rows_of(queries.op3_token_files(spark, medium), "doc_id", "start", "n_tokens", "ids_crc32"), sorted(docs))


def test_token_files_odd_rows(spark, odd, none, tmp_path):
    texts = sorted(((d, t) for d, t, *_ in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0, len(brute.ids("word_bpe_49k.json", r[1]))))
    manifest = token_files.write_token_files(odd, f"file://{tmp_path}/a")
    check_files(rows_of(token_files.read_token_files(spark, f"file://{tmp_path}/a", manifest), "doc_id", "start", "n_tokens", "ids_crc32"), texts)
    assert token_files.token_files(none).collect() == []


# licences


def test_license_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a.py", "x"), ("src/b.py", None), ("src/lib/COPYING", gpl), ("src/lib/c.py", "code"), ("src/lib/deep/er/d.py", ""), ("src/lib/e.py", "code\n" + mit), ("src/libx/f.py", "f"), (None, mit), (None, None), ("src/b.py", None)]
    df = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "1 as dir", "2 as PATH")
    found = rows_of(licenses.license_scan(df), "path", "license", "inherited_from")
    assert sorted(found, key=str) == sorted(
        [
            ("LICENSE", "MIT", None), ("a.py", "MIT", "LICENSE"), ("src/b.py", "MIT", "LICENSE"), ("src/b.py", "MIT", "LICENSE"), ("src/lib/COPYING", "GPL-3.0", None), ("src/lib/c.py", "GPL-3.0", "src/lib/COPYING"),
            ("src/lib/deep/er/d.py", "GPL-3.0", "src/lib/COPYING"), ("src/lib/e.py", "MIT", None), ("src/libx/f.py", "MIT", "LICENSE"), (None, "MIT", None), (None, None, None),
        ],
        key=str,
    )
    assert licenses.license_scan(spark.createDataFrame([], "path string, text string")).collect() == []


def test_license_query(spark, medium):
    found = queries.op4_license_scan(spark, medium).toPandas()
    assert len(found) == 1000 and found["own_license"].notna().sum() > 5
    assert set(found["own_license"].dropna()) <= set(licenses.TEMPLATES)


# contamination


def test_contamination(spark, medium, docs):
    items = rows_of(spark.read.parquet(f"{medium}/benchmark.parquet"), "item_id", "text")
    found = {r[0]: r[1:] for r in rows_of(queries.op6_decontamination(spark, medium), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
    expected = brute.contamination(docs, items)
    assert found == expected and any(e[4] for e in expected.values())
    # the same in several broadcasts
    split = decontaminate.contamination(spark.read.parquet(f"{medium}/documents.parquet"), spark.read.parquet(f"{medium}/benchmark.parquet"), most_bytes=10_000)
    assert {r[0]: r[1:] for r in rows_of(split, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")} == expected


def test_contamination_odd_rows(spark, odd, none):
    items = [(1, "w100 W101 w102"), (2, "w110,w111;w112 w113 w114 w115 w116 w117 w118 w119 w120 w121 w122 w123 w124"), (3, None), (4, ""), (None, "one two"), (1, "É"), (10, "w100 w101 w102"), (2, "!!!")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as Text")
    expected = brute.contamination([(i, t) for i, (_, t, *_) in enumerate(odd_rows())], [i for i in items if i[0] is not None])
    found = rows_of(decontaminate.contamination(odd, bench), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(found) == sorted(expected.values())
    assert decontaminate.contamination(none, bench).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(odd, bench.limit(0)).collect()} == {0}
    kept = decontaminate.without_contaminated(odd, bench)
    assert kept.columns == odd.columns
    bad = {i for i, e in expected.items() if e[4]}
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == sorted(d for i, (d, *_) in enumerate(odd_rows()) if d is not None and i not in bad)


# repeated passages


def digests(found):
    return sorted((d, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, w, k in found)


def test_substrings(spark, medium, docs):
    found = rows_of(queries.op7_substring_dedup(spark, medium), "doc_id", "n_words", "n_removed", "kept_sha256")
    expected = digests(brute.substring(docs))
    assert sorted(found) == expected and any(e[2] for e in expected)


@pytest.mark.parametrize("lot", [500, 2])
def test_substrings_odd_rows(spark, odd, none, monkeypatch, lot):
    monkeypatch.setattr(substring, "LOT", lot)  # of 2: passages are dealt over lots
    expected = [(-1 if d is None else d, *r) for d, *r in brute.substring([(d, t) for d, t, *_ in odd_rows()])]
    found = [(-1 if d is None else d, *r) for d, *r in rows_of(substring.substring_digests(odd), "doc_id", "n_words", "n_removed", "kept_sha256")]
    assert sorted(found) == digests(expected)
    assert substring.substring_digests(none).collect() == []


@pytest.mark.parametrize("lot", [500, 3])
def test_substrings_of_few_words(spark, monkeypatch, lot):
    """Many overlapping repeats of a tiny vocabulary, within and across rows, and a large group of copies."""
    monkeypatch.setattr(substring, "LOT", lot)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("ab") if i % 2 else "ab"[j // 9 % 2] for j in range(rng.randint(0, 160)))) for i in range(120)]
    rows += [(1000 + i, f"id{i} " + " ".join(f"c{j}" for j in range(60))) for i in range(40)]
    found = rows_of(substring.substring_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(found) == digests(brute.substring(rows))


def test_substring_stage_keeps_clean_texts(spark, odd):
    kept = substring.substring_dedup(odd)
    assert kept.columns == odd.columns
    by = {r[0]: r for r in kept.collect()}
    assert by[13][1] == odd_rows()[13][1]  # untouched white space
    assert 8 not in by and by[9][1] == "x y" and by[12][1] == "tail" and by[9][4] == 3


# near-duplicates


def test_simhash(spark, medium, docs):
    found = {r[0]: r[1:] for r in rows_of(queries.op8_simhash(spark, medium), "doc_id", "fingerprint", "component_id")}
    prints = [(d, brute.fingerprint(t)) for d, t in docs]
    of = brute.components(prints)
    assert found == {d: (f"{p:016x}", of[d]) for d, p in prints}


def test_keys_lose_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    for errors in range(4):
        other = base.copy()
        for i in range(len(base)):
            for bit in rng.choice(64, errors, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(bit)
        a, ka = simhash.bucket_keys(base)
        b, kb = simhash.bucket_keys(other)
        first, second = defaultdict(set), defaultdict(set)
        for i, k in zip(a, ka, strict=True):
            first[i].add(k)
        for i, k in zip(b, kb, strict=True):
            second[i].add(k)
        assert all(first[i] & second[i] for i in range(len(base)))


def test_spanning_links_connect_large_buckets():
    rng = np.random.default_rng(2)
    prints = np.unique(np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(400)], dtype=np.uint64))
    i, j = simhash.spanning_links(np.zeros(len(prints), np.int64), prints)
    assert len(i) < len(prints)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        parent[root(a)] = root(b)
    of = brute.components([(k, int(p)) for k, p in enumerate(prints)])
    groups = defaultdict(set)
    for k in range(len(prints)):
        groups[of[k]].add(root(k))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_simhash_odd_rows(spark, odd, none):
    rows = odd_rows()
    found = sorted(rows_of(simhash.simhash_components(odd), "doc_id", "fingerprint", "component_id"), key=str)
    of = brute.components([(d, brute.fingerprint(t)) for d, t, *_ in rows if d is not None])
    assert found == sorted(((d, f"{brute.fingerprint(t):016x}", of.get(d)) for d, t, *_ in rows), key=str)
    assert simhash.simhash_components(none).collect() == []
    kept = simhash.simhash_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r[0] for r in kept.collect() if r[0] is not None) == sorted(set(of.values()))
    assert sum(r[0] is None for r in kept.collect()) == 2


def test_chains_of_components(spark):
    from tidegraph.llm.components import components

    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    found = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100} | {200 + i: 200 for i in range(50)}


# quality


def test_quality_of_held_out_rows(spark, medium):
    found = {r.doc_id: r for r in queries.op9_quality(spark, medium).collect()}
    held = [(found[d], q) for d, q in rows_of(spark.read.parquet(f"{medium}/labels.parquet"), "doc_id", "quality") if found[d].held_out]
    assert len(found) == 1000 and len(held) > 80
    assert np.mean([r.predicted == q for r, q in held]) > 0.93
    good, bad = ([r.score for r, q in held if q == x] for x in (1, 0))
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (8, 1), (8, 1), (9, None), (None, 1), (999, 0), (11, 7)], "doc_id long, quality int").selectExpr("*", "1 as words")
    found = quality.quality(odd, labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.score for r in quality.quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(none, labels).collect() == []


def test_isotonic_is_monotone():
    share = quality.isotonic(np.array([2, 2, 4, 1, 1.0]), np.array([1, 0, 2, 1, 0.0]))
    assert (np.diff(share) >= 0).all() and np.allclose(share, [0.25, 0.25, 0.5, 0.5, 0.5])


# packing


def check_pieces(found, texts, size=2048):
    got = defaultdict(list)
    for r in found:
        got[r.doc_id].append(r)
    for d, t in texts:
        all_ids = brute.ids("byte_bpe_50k.json", t, 0)
        rows = sorted(got[d], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.length for r in rows) == len(all_ids) and all(r.length == size for r in rows[1:])
        assert all(r.ids_crc32 == brute.crc(all_ids[r.start : r.start + r.length]) for r in rows)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_packing(spark, medium, docs):
    found = queries.op10_packing(spark, medium).collect()
    n = check_pieces(found, docs)
    assert n <= -(-sum(r.length for r in found) // 2048) * 1.01 + 1


def test_packing_odd_rows(spark, odd, none):
    found = packing.pack(odd, lot=5).collect()
    rows = odd_rows()
    check_pieces([r for r in found if r.doc_id not in (None, 8)], [(d, t) for d, t, *_ in rows if d not in (None, 8)])
    assert sum(r.length for r in found) == sum(len(brute.ids("byte_bpe_50k.json", t, 0)) for _, t, *_ in rows)
    assert packing.pack(none).collect() == []


# the pipeline


def test_pipeline_equals_its_plain_version(spark, small):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    docs = [(d, t) for d, t in table if t and any(c.isalpha() for c in t)]
    of = brute.components([(d, brute.fingerprint(t)) for d, t in docs])
    docs = [(d, t) for d, t in docs if of[d] == d]
    texts = dict(docs)
    docs = [(d, texts[d] if len(k) == len(w) else " ".join(k)) for d, w, k in brute.substring(docs) if k or not w]
    bad = brute.contamination(docs, rows_of(spark.read.parquet(f"{small}/benchmark.parquet"), "item_id", "text"))
    docs = [(d, t) for d, t in docs if not bad[d][4]]
    found = corpus_pipeline.run(spark, small).collect()
    check_pieces(found, docs)
    assert {r.doc_id for r in found} == {d for d, _ in docs} and len(docs) < len(table)


def test_pipeline_leaves_its_result_alone(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda spark: f"file://{tmp_path}")
    found = corpus_pipeline.run(spark, small)
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1 and found.count() > 100


def test_pipeline_of_odd_rows(spark, odd, none, small):
    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns == rows.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
