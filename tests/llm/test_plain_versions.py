"""Language filters, quality scores and packing against plain versions of themselves."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from tidegraph.llm import langid, packing, quality, queries

# languages


def plain_grams(text: str | None) -> list[bytes]:
    """Four bytes from the space before the text and from each byte on, letters lower-cased, other ASCII as spaces."""
    raw = bytes(b if b >= 0x80 else (b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 0x20) for b in (text or "").encode())
    padded = b" " + raw + b"   "
    return [g for g in (padded[i : i + 4] for i in range(len(raw) + 1)) if g != b"    "]


def plain_sets(rows) -> dict[str, set[bytes]]:
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    total = {x: sum(c.values()) for x, c in counts.items()}
    share = {x: {g: n / total[x] for g, n in c.items()} for x, c in counts.items()}
    return {x: {g for g, n in c.items() if n >= max(langid.LEAST, langid.LEAST_SHARE * total[x]) and share[x][g] >= langid.KEEP * max(s.get(g, 0) for s in share.values())} for x, c in counts.items()}


def contained(model: langid.Model, gram: bytes) -> set[str]:
    data = np.array([int.from_bytes(gram, "little")], np.uint32)
    out = set()
    for part in model.parts:
        at = [int(langid._slots(data, which, part.filters.shape[2])[0]) for which in range(langid.HASHES)]
        out |= {x for i, x in enumerate(part.langs) if all(int(part.filters[i // langid.WORD, which, s]) >> i % langid.WORD & 1 for which, s in enumerate(at))}
    return out


@pytest.fixture(scope="module")
def learnt(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    rows = [(r.text, r.lang) for r in langid.train_rows(docs).collect()]
    return langid.learn(langid.train_rows(docs)), plain_sets(rows)


def test_filters_hold_all_kept_grams_and_few_others(learnt):
    model, sets = learnt
    assert set(model.langs) == set(sets)
    for lang, grams in sets.items():
        assert all(lang in contained(model, g) for g in grams)
    rng = random.Random(4)
    others = [bytes(rng.choices(range(97, 123), k=4)) for _ in range(4000)]
    for i, lang in enumerate(model.langs):
        unknown = [g for g in others if g not in sets[lang]]
        assert abs(np.mean([lang in contained(model, g) for g in unknown]) - model.false[i]) < 0.01


def test_kept_grams_equal_plain_sets(spark, medium):
    rows = langid.train_rows(spark.read.parquet(f"{medium}/documents.parquet"))
    langs, kept = langid.kept_grams(rows)
    found: dict[str, set] = {x: set() for x in langs}
    for gram, i in kept.collect():
        found[langs[i]].add(gram.to_bytes(4, "little"))
    assert found == plain_sets([(r.text, r.lang) for r in rows.collect()])


def test_predictions_equal_plain_counts(spark, medium, learnt):
    model, sets = learnt
    found = {r.doc_id: r for r in queries.op2_language_id(spark, medium).collect()}
    wrong = 0
    for r in spark.read.parquet(f"{medium}/documents.parquet").collect():
        grams = plain_grams(r.text)
        hits = [sum(g in sets[x] for g in grams) for x in model.langs]
        best = hits.index(max(hits))
        wrong += found[r.doc_id].lang_pred != model.langs[best]
        if found[r.doc_id].lang_pred == model.langs[best]:
            assert abs(found[r.doc_id].score - hits[best] / max(1, sum(hits))) < 0.02
            assert abs(found[r.doc_id].coverage - hits[best] / max(1, len(grams))) < 0.02
    assert wrong <= 2  # ties that the filters' false hits decide


def many_languages(n: int):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(30)]
        rows += [(100 * k + i, " ".join(rng.choices(words, k=60)), f"lang{k:03d}") for i in range(6)]
    return [*rows, (100_000, None, "lang000"), (100_001, "77 !", None), (None, rows[0][1], None)]


def test_a_hundred_languages(spark):
    rows = many_languages(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = langid.learn(docs)
    assert len(whole.langs) == 100 and len(whole.parts) == 1
    dealt = langid.learn(docs, most_bytes=1)
    assert len(dealt.parts) > 5 and dealt.langs == whole.langs
    truth = {d: x for d, _, x in rows if x}
    for model in (whole, dealt):
        found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
        assert len(found) == len(rows) and found[100_000].lang_pred == found[100_001].lang_pred == "und"
        assert np.mean([found[d].lang_pred == x for d, x in truth.items()]) > 0.99
        assert found[None].lang_pred == "lang000"
    one, many = ({(r.doc_id, r.lang_pred, round(r.score, 9), round(r.coverage, 9)) for r in langid.predict(docs, m).collect()} for m in (whole, dealt))
    assert one == many


def test_the_stage_names_languages_and_rejects_unknown_ones(spark):
    rows = [(i, "the quick brown fox and the lazy dog of the town", "en") for i in range(40)]
    rows += [(100, "zxqv kjwp vvqz xkcd", None), (101, "77", None), (102, "the dog and the fox", None), (102, "the dog and the fox", "xx"), (None, "the fox", None), (None, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = langid.with_language(docs).collect()
    assert sorted((str(r.doc_id), str(r.lang)) for r in kept if r.doc_id is None or r.doc_id > 50) == [("102", "en"), ("102", "xx"), ("None", "None")]
    assert sum(r.lang == "en" for r in kept) == 41


# quality


def plain_statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    n, size = max(1, len(words)), max(1, len(raw))
    share = [sum(f(b) for b in raw) / size for f in quality._CLASSES.values()]
    mean = sum(map(len, words)) / n
    spread = max(0.0, sum(len(w) ** 2 for w in words) / n - mean**2) ** 0.5
    threes = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    top = max(Counter(words).values(), default=0)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), *share, np.log1p(mean), np.log1p(spread), len(set(words)) / n, top / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(threes) / max(1, len(words) - 2), np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
    ]


def test_statistics_equal_plain_ones(spark, medium):
    texts = [r.text for r in spark.read.parquet(f"{medium}/documents.parquet").limit(150).collect()] + [None, "", "\n\n", "a a a\na a a\n", "É! 12|3  \t x"]
    np.testing.assert_allclose(quality.statistics(pa.array(texts)), [plain_statistics(t) for t in texts], atol=1e-9)


def lowest_of_highest(n, good):
    """Isotonic regression by its min-max formula."""
    mean = lambda a, b: good[a : b + 1].sum() / n[a : b + 1].sum()
    return np.array([max(min(mean(a, b) for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))])


def test_scores_equal_a_whole_table_fit(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{small}/labels.parquet").collect()]
    found = {r.doc_id: r for r in queries.op9_quality(spark, small).collect()}
    x = np.array([plain_statistics(t) for _, t in docs])
    place = {d: i for i, (d, _) in enumerate(docs)}
    crc = {d: zlib.crc32(str(d).encode()) % 3 for d in place}
    rng = np.random.default_rng(20)
    d = x.shape[1]
    w, phase = rng.normal(size=(d, quality.FOURIER)) / (quality.WIDTH * d**0.5), rng.uniform(0, 2 * np.pi, quality.FOURIER)
    deviation = x.std(axis=0)
    z = np.clip((x - x.mean(axis=0)) / np.where(deviation > 1e-12, deviation, 1), -6, 6)
    z = np.concatenate([np.sqrt(2 / quality.FOURIER) * np.cos(z @ w + phase), z, np.ones((len(z), 1))], axis=1)
    learn = [(place[i], q, (xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) + (1 << 63)) % (1 << 64) - (1 << 63)) for i, q in labels if crc[i] != 1 and q in (0, 1)]
    rows, y, fold = np.array([r[0] for r in learn]), np.array([r[1] for r in learn], float), np.array([r[2] % quality.FOLDS for r in learn])

    def fit(use):
        a = np.sqrt(np.append(np.full(z.shape[1] - 1, quality.RIDGE * use.sum() + 1e-9), 2e-9))
        return np.linalg.lstsq(np.concatenate([z[rows[use]], np.diag(a)]), np.append(y[use], np.zeros(z.shape[1])), rcond=None)[0]

    raw = lambda at, weights: np.clip(z[at] @ weights, quality.LOW, quality.HIGH)
    out = np.array([raw(r, fit(fold != f)) for r, f in zip(rows, fold, strict=True)])
    at = quality._bin(out)
    bins = np.unique(at)
    n, good = np.array([(at == b).sum() for b in bins], float), np.array([y[at == b].sum() for b in bins])
    score = np.interp(raw(np.arange(len(z)), fit(np.ones(len(rows), bool))), quality.LOW + (bins + 0.5) * (quality.HIGH - quality.LOW) / quality.BINS, lowest_of_highest(n, good))
    got = np.array([found[i].score for i, _ in docs])
    # a score on the edge of a bin may fall on either side of it
    assert np.quantile(np.abs(got - score), 0.9) < 1e-3 and np.abs(got - score).max() < 0.15
    assert all(found[i].held_out == (crc[i] == 1) and found[i].predicted == int(found[i].score >= 0.5) for i in place)


# packing


def plain_packing(lengths, size):
    """Each piece into the gap that leaves the least sum of squared counts of open sequences by gap; of equals the smallest gap."""
    gaps, out = [], []  # the open sequences' gaps, by number
    for s in lengths:
        counts = Counter(g for g in gaps if g)
        best = None
        for g in sorted(counts):
            if g >= s:
                after = counts.copy()
                after[g] -= 1
                if g > s:
                    after[g - s] += 1
                total = sum(n * n for n in after.values())
                if best is None or total < best[0]:
                    best = (total, g)
        if best is None:
            gaps.append(size - s)
            out.append((len(gaps) - 1, 0))
        else:
            k = [i for i, g in enumerate(gaps) if g == best[1]]
            out.append((k, size - best[1]))
            gaps[k[-1]] = best[1] - s
    return out, gaps


def test_placement_equals_the_plain_rule():
    rng = random.Random(6)
    for _ in range(60):
        size = rng.choice([10, 40, 200])
        lengths = sorted((min(size, max(1, int(rng.lognormvariate(2, 1)))) for _ in range(rng.randint(1, 150))), reverse=True)
        sequence, offset = packing.sum_of_squares(np.array(lengths), size)
        _, gaps = plain_packing(lengths, size)
        fill = Counter()
        for s, n in zip(sequence.tolist(), lengths, strict=True):
            fill[s] += n
        assert sorted(size - n for n in fill.values()) == sorted(gaps)  # sequences of one gap are interchangeable
        assert all(offset[i] + n <= size for i, n in enumerate(lengths))


def test_query_places_each_lot_by_the_plain_rule(spark, small):
    found = queries.op10_packing(spark, small).orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32").collect()
    _, gaps = plain_packing([r.length for r in found], 2048)
    fill = Counter()
    for r in found:
        fill[r.sequence_id] += r.length
    assert len(found) < packing.LOT and sorted(2048 - n for n in fill.values()) == sorted(gaps)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert sum(fill.values()) == sum(len(brute.ids("byte_bpe_50k.json", t, 0)) for t in texts.values())
