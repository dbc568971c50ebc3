"""Very long texts, hot keys and extreme values: the same results, in bounded memory."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from tidegraph.llm import decontaminate, langid, nearest, quality, simhash, substring, token_files, tokens
from tidegraph.llm import text as T

# long texts


def texts(seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(300)] + ["x" * 90, "É", "a"]
    line = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(n))
    return [line(1500), None, "", "one two", line(40), "y" * 3000 + " tail of it", line(700) + "z" * 2500, " \n" * 800]


def word_runs(array: pa.Array, overlap: int) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(len(array))]
    for row, data, starts, ends, first, base in T.pieces(array, T.NON_SPACE, overlap):
        hashes = T.word_hashes(data, starts, ends).tolist()
        for r in range(len(first) - 1):
            mine = hashes[first[r] : first[r + 1]]
            if base:
                assert out[row + r][-overlap:] == mine[:overlap] if overlap else True
                assert len(out[row + r]) == base + overlap
            out[row + r] += mine[overlap if base else 0 :]
    return out


def windows(array: pa.Array) -> set[tuple[int, int, int]]:
    out = set()
    for row, base, start, of_row, first, end, _, keys in substring._runs(array, 35, 18):
        out |= {(row + int(of_row[a]), int(i - start[of_row[a]]) + base, int(keys[i])) for a, z in zip(first, end, strict=True) for i in range(a, z)}
    return out


def all_grams(array: pa.Array) -> list[tuple[int, int]]:
    return [(row + int(r), int(g)) for row, data, offsets in T.slices(array) for some, rows in langid.grams(data, offsets) for g, r in zip(some, rows, strict=True)]


@pytest.mark.parametrize("piece", [30, 500, 4000])
def test_pieces_change_nothing(monkeypatch, piece):
    array = pa.array(texts())
    whole = [word_runs(array, 0), windows(array), all_grams(array), quality.statistics(array), simhash.fingerprints(array).tolist()]
    assert whole[4] == [brute.fingerprint(t) for t in texts()]
    monkeypatch.setattr(T, "PIECE", piece)
    assert all(word_runs(array, k) == whole[0] for k in (0, 2, 12, 34))
    assert windows(array) == whole[1] and all_grams(array) == whole[2]
    np.testing.assert_allclose(quality.statistics(array), whole[3], atol=1e-12)
    assert simhash.fingerprints(array).tolist() == whole[4]


def test_memory_hardly_grows_with_a_text():
    """Kernels over one text of 24 MB; a run of 10 MB took 570 MB before."""
    rng = random.Random(1)
    array = pa.array(["".join(rng.choices([f"w{i} " for i in range(50_000)], k=4_000_000))])
    size = len(array[0].as_buffer())
    known = decontaminate.Windows({b"w1 w2 w3": {"1"}})

    def hits():
        for _, data, starts, ends, first, _ in T.pieces(array, T.ALNUM, 12, T.LOWER):
            yield from known.hits(data, starts, ends, np.zeros(len(starts), int), T.word_hashes(data, starts, ends))

    kernels = {
        "words": lambda: sum(len(x[2]) for x in T.pieces(array, T.NON_SPACE, 34)),
        "anchors": lambda: sum(len(x[6]) for x in substring._runs(array, 35, 18)),
        "benchmark": lambda: len(list(hits())),
        "fingerprint": lambda: simhash.fingerprints(array),
        "grams": lambda: sum(len(g) for _, data, offsets in T.slices(array) for g, _ in langid.grams(data, offsets)),
        "removal": lambda: sum(n for n, _ in substring._kept(array[0].as_py().encode(), None)),
        "statistics": lambda: quality.statistics(array),
    }
    for name, run in kernels.items():
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # the statistics hold a hash for each different run of three words, here nearly every one
        assert peak < (7 * size if name == "statistics" else 4 * size), f"{name}: {peak / size:.1f} bytes a byte"


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_of_long_texts(monkeypatch, vocabulary):
    monkeypatch.setattr(tokens, "CHUNK", 50)
    encoder = tokens.Encoder(tokens.path(vocabulary))
    rng = random.Random(2)
    for text in [*texts(5), *("".join(rng.choice(["a", "the", " ", "  ", "\n", "'s", " 12", "!", "<|endoftext|>", "é", "\t", " x"]) for _ in range(900)) for _ in range(40))]:
        assert np.frombuffer(encoder.encode([text or ""])[0], encoder.dtype).tolist() == brute.ids(vocabulary, text)


def test_xxh64_equals_the_library():
    rng = random.Random(7)
    raw = rng.randbytes(5000)
    spans = [(a, a + rng.choice([0, 1, 3, 4, 7, 8, 15, 31, 32, 33, 64, 100, 255, 256, 257, 400])) for a in (rng.randrange(4500) for _ in range(3000))] + [(4990, 5000), (5000, 5000)]
    starts, ends = (np.array(x) for x in zip(*spans, strict=True))
    assert T.xxh64(np.frombuffer(raw, np.uint8), starts, ends, 42).tolist() == [xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in spans]


# hot keys


def linked(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    return [root(x) for x in range(n)]


def one_bucket(n: int, seed: int = 1) -> np.ndarray:
    """Different fingerprints that share a key: sixteen bits, and the other 48 random or few bits from another's."""
    g = np.random.default_rng(seed)
    base = g.integers(0, 1 << 48, n // 4, dtype=np.uint64) << np.uint64(16)
    near = [base ^ (np.uint64(1) << g.integers(16, 64, len(base)).astype(np.uint64)) ^ (np.uint64(1) << g.integers(16, 64, len(base)).astype(np.uint64)) for _ in range(3)]
    return np.unique(np.concatenate([base, *near]) | np.uint64(5))


def test_a_hundred_thousand_fingerprints_in_one_bucket():
    prints = one_bucket(100_000)
    i, j = simhash.spanning_links(np.zeros(len(prints), np.int64), prints)
    assert (np.bitwise_count(prints[i] ^ prints[j]) <= simhash.RADIUS).all() and len(i) < 12 * len(prints)
    root = linked(len(prints), zip(i.tolist(), j.tolist(), strict=True))
    some = np.random.default_rng(3).choice(len(prints), 300, replace=False)  # against all others
    for a in some.tolist():
        assert {root[b] for b in np.flatnonzero(np.bitwise_count(prints ^ prints[a]) <= simhash.RADIUS).tolist()} == {root[a]}


@pytest.mark.parametrize(("hot", "batch"), [(10, 7), (10, 1000), (10**9, 64)])
def test_hot_buckets_are_dealt_anew(hot, batch):
    prints = np.concatenate([one_bucket(900), one_bucket(40, 2) ^ np.uint64(1 << 20)])
    prints = np.unique(prints)
    at, keys = simhash.bucket_keys(prints)

    def batches(rows):
        rows = sorted(rows)
        for i in range(0, len(rows), batch):
            k, p, n = zip(*rows[i : i + batch], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(np.array(p, np.uint64).view(np.int64)), pa.array(n, pa.int64())], names=["key", "print", "node"])

    out = [r for b in simhash._link_batches(batches(zip(keys.tolist(), prints[at].tolist(), at.tolist(), strict=True)), hot) for r in b.to_pylist()]
    again = [(r["key"], r["print"] % (1 << 64), r["node"]) for r in out if r["key"] is not None]
    pairs = [(r["a"], r["b"]) for r in out if r["key"] is None] + [(r["a"], r["b"]) for b in simhash._link_batches(batches(again)) for r in b.to_pylist()]
    assert again or hot > 10 or batch > 7  # a bucket that lies within a batch isn't hot
    expected = brute.components([(k, int(p)) for k, p in enumerate(prints)])
    assert linked(len(prints), pairs) == [expected[k] for k in range(len(prints))]


def test_components_with_hot_buckets(spark, medium, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_BUCKET", 2)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{medium}/documents.parquet").limit(300).collect()]
    found = {r.doc_id: r.component_id for r in simhash.simhash_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == brute.components([(d, brute.fingerprint(t)) for d, t in docs])


def test_one_long_repetitive_text_and_copies_without_ids(spark, monkeypatch):
    monkeypatch.setattr(substring, "LOT", 3)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, " ".join([passage] * 60) + " once"), *[(None, f"{passage} only here") for _ in range(30)], (2, "q " * 300), (3, passage.replace("p7 ", "p8 "))]
    found = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.substring_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    sha = lambda words: __import__("hashlib").sha256(" ".join(words).encode()).hexdigest()
    assert found == sorted((str(d), len(w), len(w) - len(k), sha(k)) for d, w, k in brute.substring(rows))


def test_sketch_of_few_cells_loses_nothing(spark, medium, monkeypatch):
    """Beyond its bound the sketch lets more windows pass, and the groups stay exact."""
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    expected = sorted(map(tuple, substring.substring_digests(docs).collect()))
    monkeypatch.setattr(substring, "SKETCH_BITS", 12)
    monkeypatch.setattr(substring, "HEAVY", 50)
    assert sorted(map(tuple, substring.substring_digests(docs).collect())) == expected


def test_a_shared_id_fills_several_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2_000)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * (i % 9)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest = token_files.write_token_files(docs, f"file://{tmp_path}/a").cache()
    found = sorted(token_files.read_token_files(spark, f"file://{tmp_path}/a", manifest).collect(), key=lambda r: r.start)
    sizes = [r.docs for r in manifest.orderBy("part").collect()]
    assert len(sizes) > 4 and max(sizes) < 100  # a third of the rows has no id, another third the id 7
    ids = [-(1 << 62) if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids) and [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    encoded = [(str(d), brute.ids("word_bpe_49k.json", t, 1)) for d, t in rows]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted((d, len(x), brute.crc(x)) for d, x in encoded)


# extreme values


@pytest.mark.parametrize("factor", [1.0, 1e150, 1e-150, 1e-300])
def test_nearest_of_extreme_vectors(spark, factor):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) * factor * 10.0 ** rng.integers(-3, 3)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (None, 30):
        found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.nearest(df, every=20, k=7, block=block).collect())
        expected = []
        for q, x in rows:
            if q % 20 == 0:
                pairs = []
                for c, y in rows:
                    if c != q:
                        s = 0.0
                        for a, b in zip(x, y, strict=True):
                            s += a * b
                        pairs.append((-s, c))
                expected += [(q, k, c, -s) for k, (s, c) in enumerate(sorted(pairs)[:7], 1)]
        assert found == expected


def test_nearest_whose_scores_overflow(spark):
    big = 1e200
    rows = [(0, [big, 1.0]), (1, [big, 0.0]), (2, [-big, 0.0]), (3, [0.0, 2.0]), (4, [1e-200, 3.0]), (20, [big, -big]), (5, [big, big])]
    found = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect()
    inf = float("inf")
    assert [(r.vec_id, r.score) for r in found if r.query_id == 0] == [(1, inf), (5, inf), (20, inf), (4, 4.0), (3, 2.0), (2, -inf)]
    of = {r.vec_id: r for r in found if r.query_id == 20}
    assert np.isnan(of[5].score) and of[1].score == inf and of[5]["rank"] > of[3]["rank"] and len(of) == 6


def test_partial_spans_meet_over_lots(spark):
    assert substring.substring_digests(spark.createDataFrame([(1, None)], "doc_id long, text string")).select(F.sum("n_words")).first()[0] == 0
