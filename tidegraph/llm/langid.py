"""Language identification by bit-sliced Bloom filters of byte n-grams.

Each slot of a filter is a bitmask over languages, so one lookup per hash tests all
languages at once: the AND of an n-gram's slots names the languages that contain it.
A language contains an n-gram if the n-gram's share of that language's n-grams is at
least `KEEP` times its largest share in any language.  A text's hits per language,
corrected for the filters' rate of false positives, decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import text as T
from .shared import column, held_out, map_batches, numbered, pick, spread, without, written

GRAM = 4
HASHES = 2
KEEP = 0.25
#: An n-gram counts in a language from so many occurrences and so large a share, which bounds a language's n-grams.
LEAST, LEAST_SHARE = 3, 1e-6
#: Slots of a filter: at least, and for each n-gram of the language that has most.
SLOTS, SLOTS_PER_GRAM = 1 << 20, 8
#: Bytes of the filters that are broadcast at once; the languages beyond are scanned for by themselves.
MOST_BYTES = 64 << 20
#: Bits of a mask, and n-grams that a partition holds before it gives them out.
WORD, HELD = 64, 2_000_000
_MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))

#: Letters lower-cased, other ASCII bytes as a space, UTF-8 bytes as they are.
_LETTER = np.array([0x20 if not (chr(b).isalpha() or b >= 0x80) else T.LOWER[b] for b in range(128)] + list(range(128, 256)), dtype=np.uint8)


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of the rows, each row padded by spaces, and the row of each; runs of spaces alone are left out.

    The n-grams of a long text come in pieces.
    """
    if T.long(data, offsets):
        for at in range(0, len(data) + 1, T.PIECE):
            stop = min(at + T.PIECE, len(data) + 1)  # an n-gram starts at the space before the text and at each byte
            some = _LETTER[data[max(at - 1, 0) : stop + GRAM - 2]]
            padded = np.full(stop - at + GRAM - 1, 0x20, dtype=np.uint8)
            padded[at == 0 :][: len(some)] = some
            g = _packed(padded, stop - at)
            g = g[g != 0x20202020]
            yield g, np.zeros(len(g), np.int64)
        return
    n = len(offsets) - 1
    padded = np.full(len(data) + 4 * n + GRAM, 0x20, dtype=np.uint8)
    at = offsets[:-1] + 4 * np.arange(n) + 1  # where each row starts
    shift = np.repeat(4 * np.arange(n) + 1, np.diff(offsets))
    padded[np.arange(len(data)) + shift] = _LETTER[data]
    m = len(data) + 4 * n
    g = _packed(padded, m)
    # an n-gram that starts in the last three bytes of a row's padding would reach into the next row
    row = np.repeat(np.arange(n), np.diff(offsets) + 4)
    inside = np.arange(m) < (at + np.diff(offsets))[row]
    keep = inside & (g != 0x20202020)
    yield g[keep], row[keep]


def _packed(padded: np.ndarray, m: int) -> np.ndarray:
    p = padded.astype(np.uint32)
    return p[:m] | p[1 : m + 1] << 8 | p[2 : m + 2] << 16 | p[3 : m + 3] << 24


def _slots(g: np.ndarray, which: int, slots: int) -> np.ndarray:
    return ((g ^ (g >> np.uint32(15))) * _MULTIPLIERS[which]) >> np.uint32(33 - slots.bit_length())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a partition, added up so that each pair leaves once or a few times."""
    held: dict[str, list] = {}
    size = 0

    def added(parts: list) -> tuple[np.ndarray, np.ndarray]:
        g, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return g, np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            g, n = added(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    for b in batches:
        for lang in b.column(1).unique().to_pylist():
            rows = b.column(0).filter(pc.equal(b.column(1), lang))
            for _, data, offsets in T.slices(rows):
                for g, _ in grams(data, offsets):
                    g, n = np.unique(g, return_counts=True)
                    held.setdefault(lang, []).append((g, n))
                    size += len(g)
        if size > HELD:
            held = {lang: [added(parts)] for lang, parts in held.items()}
            size = sum(len(p[0][0]) for p in held.values())
        if size > HELD:
            yield from out()
            held, size = {}, 0
    yield from out()


class Filters:
    """Filters of some of the languages: [mask word, hash, slot], a language a bit."""

    def __init__(self, langs: list[str], filters: np.ndarray, first: int = 0):
        self.langs, self.first = langs, first  # first: how many languages of the corpus come before
        self.filters = filters
        self.false = np.array([np.prod([(f >> f.dtype.type(i % WORD) & f.dtype.type(1)).mean() for f in filters[i // WORD]]) for i in range(len(langs))])

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each row, and [row, language] how many of them the language contains, corrected."""
        n = len(offsets) - 1
        total, raw = np.zeros(n, np.int64), np.zeros((n, len(self.langs)))
        for g, row in grams(data, offsets):
            total += np.bincount(row, minlength=n)
            at = [_slots(g, which, self.filters.shape[2]) for which in range(HASHES)]
            for word, filters in enumerate(self.filters):
                mask = filters[0][at[0]]
                for which in range(1, HASHES):
                    mask &= filters[which][at[which]]
                for i in range(min(WORD, len(self.langs) - word * WORD)):
                    raw[:, word * WORD + i] += np.bincount(row[(mask >> i & 1).astype(bool)], minlength=n)
        return total, np.maximum(raw - total[:, None] * self.false, 0) / (1 - np.minimum(self.false, 0.999999))


class Model:
    """All languages, in as many filters as their size asks for."""

    def __init__(self, parts: list[Filters]):
        self.parts = parts
        self.langs = [x for p in parts for x in p.langs]
        self.false = np.concatenate([np.empty(0), *(p.false for p in parts)])


def kept_grams(docs: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages, by the size of their texts (ties by name), and (gram, i): the n-grams that language i contains."""
    rows = pick(docs, "text", "lang").where("text is not null and lang is not null")
    counts = written(map_batches(spread(rows), _counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    # one row a language; a language without any n-gram has none
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").collect()
    known = docs.sparkSession.createDataFrame([(r["lang"], i, float(r["total"])) for i, r in enumerate(sizes)], "lang string, i int, total double")
    share = counts.join(F.broadcast(known), "lang").withColumn("share", F.col("n") / F.col("total"))
    kept = share.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).where((F.col("share") >= KEEP * F.col("most")) & (F.col("n") >= F.greatest(F.lit(LEAST), LEAST_SHARE * F.col("total"))))
    return [r["lang"] for r in sizes], kept.select("gram", "i")


def learn(docs: DataFrame, most_bytes: int = MOST_BYTES) -> Model:
    """A model of docs' text by lang, each of its filters of at most `most_bytes`; rows with a null in either are left out.

    What reaches the driver is the names of the languages and the filters.  Languages stand
    in the order of their texts' size, so ties go to the larger.
    """
    langs, kept = kept_grams(docs)
    if not langs:
        return Model([])
    kept = written(kept, "kept-grams")
    most = kept.groupBy("i").count().agg(F.max("count")).first()[0] or 0
    slots = max(SLOTS, 1 << int(SLOTS_PER_GRAM * most - 1).bit_length() if most else 0)
    each = max(8, most_bytes * 8 // (HASHES * slots) // WORD * WORD)

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """This partition's slots of each word and hash as two arrays, so that the driver reads few rows."""
        parts: dict[int, list] = {}
        for b in batches:
            word, g, mask = (c.to_numpy() for c in b.columns)
            for w in np.unique(word).tolist():
                at = word == w
                parts.setdefault(w, []).append((g[at].astype(np.uint32), mask[at].view(np.uint64)))
        for w, found in parts.items():
            g, mask = (np.concatenate(x) for x in zip(*found, strict=True))
            for which in range(HASHES):
                at = _slots(g, which, slots)
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order], prepend=-1))
                yield pa.RecordBatch.from_arrays([pa.array([w], pa.int32()), pa.array([which], pa.int32()), pa.array([at[order][cuts].astype("<u4").tobytes()]), pa.array([np.bitwise_or.reduceat(mask[order], cuts).astype("<u8").tobytes()])], names=["word", "which", "slots", "masks"])

    parts = []
    for first in range(0, len(langs), each):
        own = langs[first : first + each]
        bit = (F.col("i") - first).alias("bit")
        masks = kept.where(F.col("i").between(first, first + len(own) - 1)).select("gram", bit).groupBy(F.expr(f"bit div {WORD}").cast("int").alias("word"), "gram").agg(F.bit_or(F.expr(f"shiftleft(1L, cast(bit % {WORD} as int))")).alias("mask"))
        words = -(-len(own) // WORD)
        filters = np.zeros((words, HASHES, slots), np.uint8 if len(own) <= 8 else np.uint64)
        for word, which, at, mask in map_batches(masks.select("word", "gram", "mask"), filled, "word int, which int, slots binary, masks binary").toLocalIterator():
            filters[word, which, np.frombuffer(at, "<u4")] |= np.frombuffer(mask, "<u8").astype(filters.dtype)
        parts.append(Filters(own, filters, first))
    return Model(parts)


PREDICTED = "doc_id long, lang_pred string, score double, coverage double"


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row of a run has a letter."""
    if T.long(data, offsets):
        out = np.array([any(((_LETTER[x] != 0x20) & (x < 0x80)).any() for x in np.array_split(data, -(-len(data) // T.PIECE)))])
    else:
        out = np.diff(np.concatenate([[0], np.cumsum((_LETTER[data] != 0x20) & (data < 0x80))])[offsets]) > 0
    for i in np.flatnonzero(~out).tolist():  # texts without an ASCII letter
        raw = data[offsets[i] : offsets[i + 1]]
        out[i] = bool((raw >= 0x80).any()) and any(c.isalpha() for c in raw.tobytes().decode())
    return out


def _scan(rows: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, best (its place among all languages; -1 without a letter), most and total hits, n-grams of every row of rows (doc_id, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for b in batches:
            n = len(b)
            best, most, total, size = np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
            for row, data, offsets in T.slices(b.column(1)):
                at = slice(row, row + len(offsets) - 1)
                size[at], hits = filters.hits(data, offsets)
                best[at] = np.where(_lettered(data, offsets), hits.argmax(axis=1) + filters.first, -1)
                most[at], total[at] = hits.max(axis=1), hits.sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (best, most, total, size))], names=["doc_id", "best", "most", "total", "grams"])

    return map_batches(spread(rows), run, "doc_id long, best int, most double, total double, grams long")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, coverage of every row of docs.

    score is the winner's part of all languages' hits, coverage the part of the text's
    n-grams that the winner contains.  `und`, with score 0, for null texts, texts without
    a letter, or a model without languages; a text whose n-grams are unknown gets the largest
    language with score 0.  Null ids and repeated rows pass through.

    Several filters are scanned for one by one, and their hits meet by a row key.
    """
    rows = pick(docs, "doc_id", "text")
    if not model.langs:
        return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("coverage"))
    if len(model.parts) == 1:
        found = _scan(rows, model.parts[0])
    else:
        keyed = written(rows.withColumn("__row", F.monotonically_increasing_id()), "texts")
        parts = [_scan(keyed.select(F.col("__row").alias("doc_id"), "text"), p) for p in model.parts]
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
        best = F.max_by("best", F.struct("most", -F.col("best")))
        united = union.groupBy("doc_id").agg(best.alias("best"), F.max("most").alias("most"), F.sum("total").alias("total"), F.max("grams").alias("grams"))
        found = keyed.select("__row", F.col("doc_id").cast("long")).join(united.withColumnRenamed("doc_id", "__row"), "__row").drop("__row")
    names = F.array(*[F.lit(x) for x in model.langs])
    score = F.least(F.lit(1.0), F.col("most") / F.greatest("total", F.lit(1e-12)))
    coverage = F.least(F.lit(1.0), F.col("most") / F.greatest("grams", F.lit(1)))
    none = F.col("best") < 0
    return found.select("doc_id", F.when(none, "und").otherwise(F.get(names, F.col("best"))).alias("lang_pred"), F.when(none, 0.0).otherwise(score).alias("score"), F.when(none, 0.0).otherwise(coverage).alias("coverage"))


def train_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32 of doc_id as text isn't 2 modulo 4; a null id is learnt from."""
    return pick(docs, "doc_id", "text", "lang").where(~F.coalesce(held_out(4, 2), F.lit(False)))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, coverage of every row, by a model of the rows that aren't held out."""
    found = predict(docs, learn(train_rows(docs)))
    return found.select("doc_id", F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score", "coverage")


#: The pipeline's language stage drops texts of which the winner contains less than this part of the n-grams.
LEAST_COVERAGE = 0.25


def with_language(docs: DataFrame, least_coverage: float = LEAST_COVERAGE) -> DataFrame:
    """docs whose text is in one of the languages learnt; rows without doc_id stay if they have a text.

    Null texts, texts without a letter and texts whose winning language contains less than
    `least_coverage` of their n-grams go.  A null `lang` becomes the prediction (of rows
    with a doc_id); other values stay.  Without any language learnt, all texts with a
    letter stay as they are.
    """
    model = learn(train_rows(docs))
    if not model.langs:
        bad = pick(docs, "doc_id", "text").where(~F.col("text").rlike(r"\p{L}")).where("doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
        return without(numbered(docs).where(column(docs, "text").isNotNull()).toDF(*docs.columns), bad)
    found = written(predict(docs, model), "languages")
    bad = found.where((F.col("doc_id").isNotNull()) & ((F.col("lang_pred") == "und") | (F.col("coverage") < least_coverage))).select(F.col("doc_id").alias("__id")).distinct()
    kept = without(numbered(docs).where(column(docs, "text").isNotNull()).toDF(*docs.columns), bad)
    # only rows without a language are joined; of rows that repeat an id the smallest prediction counts
    lacking = pick(docs, "doc_id", "lang").where("lang is null and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
    if lacking.isEmpty():
        return kept
    named = written(found.join(lacking, found["doc_id"] == lacking["__id"], "left_semi").groupBy(F.col("doc_id").alias("__id")).agg(F.min("lang_pred").alias("__pred")), "named")
    rows, at = numbered(kept), docs.columns.index("lang")
    joined = rows.join(named, (column(docs, "doc_id") == F.col("__id")) & F.col(f"__c{at}").isNull(), "left")
    return joined.select(*[F.coalesce(f"__c{i}", "__pred").alias(f"__c{i}") if i == at else F.col(f"__c{i}") for i in range(len(docs.columns))]).toDF(*docs.columns)
