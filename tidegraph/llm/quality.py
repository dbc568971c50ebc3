"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of each whole text are standardised over all documents.  Cosines of random
projections approximate a Gaussian kernel over them; partitions sum the normal
equations of the labelled rows, the ridge solution scores every row, and pooled
adjacent violators over fixed score bins turn scores into probabilities.  The bins are of
scores that each labelled row gets from a solution without its own fold, so calibration
sees no row that was fitted.  Only sums of a fixed size reach the driver: label rows need
no bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import held_out, map_batches, pick, spread, written

FOURIER = 256
#: Kernel width, in standard deviations times the root of the number of statistics.
WIDTH = 0.7
RIDGE = 1e-4
BINS, LOW, HIGH = 3000, -1.0, 2.0
#: Parts of the labelled rows, by a hash of doc_id: a solution for each of the sums without that part.
FOLDS = 5

_CLASSES = {
    "upper": lambda b: 65 <= b <= 90,
    "lower": lambda b: 97 <= b <= 122,
    "digit": lambda b: 48 <= b <= 57,
    "stop": lambda b: b in b".,;:",
    "shout": lambda b: b in b"!?",
    "bar": lambda b: b == 0x7C,
    "symbol": lambda b: 33 <= b < 127 and not chr(b).isalnum() and b not in b".,;:!?|",
    "other": lambda b: b >= 128,
    "line": lambda b: b == 10,
}
_MASKS = np.array([[f(b) for b in range(256)] for f in _CLASSES.values()])
STATISTICS = ["bytes", "words", *_CLASSES, "length", "spread", "distinct", "top", "twice", "threes", "lines", "same_lines"]
_NOT_LINE = T._classes(b"\n")


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, how many values differ and how often the most frequent occurs."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])]))
    top = np.zeros(n)
    np.maximum.at(top, r[new], np.diff(np.append(new, len(h))))
    return np.bincount(r[new], minlength=n).astype(float), top


def statistics(texts: pa.Array) -> np.ndarray:
    """[row, statistic]; null texts count as empty."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for row, data, offsets in T.slices(texts):
        if T.long(data, offsets):
            out[row] = _long_statistics(data)
            continue
        n = len(offsets) - 1
        size = np.diff(offsets).astype(float)
        starts, ends, first = T.words(data, offsets, T.NON_SPACE)
        count = np.diff(first).astype(float)
        rows = np.repeat(np.arange(n), np.diff(first))
        length = (ends - starts).astype(float)
        hashes = T.word_hashes(data, starts, ends)
        distinct, top = _distinct(hashes, rows, n)
        twice = np.bincount(rows[1:][(hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])], minlength=n)
        threes = T.rolling(hashes, 3)
        inside = rows[: len(threes)] == rows[2:] if len(threes) else np.empty(0, bool)
        three, _ = _distinct(threes[inside], rows[: len(threes)][inside], n)
        a, z, line = T.words(data, offsets, _NOT_LINE)
        lines = np.diff(line).astype(float)
        different, _ = _distinct(T.word_hashes(data, a, z), np.repeat(np.arange(n), np.diff(line)), n)
        classes = np.stack([np.diff(np.concatenate([[0], np.cumsum(mask[data])])[offsets]) for mask in _MASKS])
        out[row : row + n] = _summary(size, count, classes, np.bincount(rows, length, minlength=n), np.bincount(rows, length**2, minlength=n), distinct, top, twice, three, lines, different)
    return out


def _summary(size, count, classes, length, squares, distinct, top, twice, three, lines, different) -> np.ndarray:
    """[row, statistic] of rows of counts."""
    any_word = np.maximum(count, 1)
    mean = length / any_word
    spread = np.sqrt(np.maximum(squares / any_word - mean**2, 0))
    shares = list(classes / np.maximum(size, 1))
    return np.stack(
        [np.log1p(size), np.log1p(count), *shares, np.log1p(mean), np.log1p(spread), distinct / any_word, top / any_word, twice / any_word, three / np.maximum(count - 2, 1), np.log1p(lines), 1 - different / np.maximum(lines, 1)], axis=1
    )


class _Counts:
    """How often each value occurs, added up from parts; merged only when as much is new as there was."""

    def __init__(self) -> None:
        self.values, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.new.append(values)
        self.size += len(values)
        if self.size > max(T.PIECE, len(self.values)):
            self.merge()

    def merge(self) -> None:
        values, n = np.unique(np.concatenate([np.empty(0, np.uint64), *self.new]), return_counts=True)
        self.new, self.size = [], 0
        at = np.minimum(np.searchsorted(self.values, values), max(0, len(self.values) - 1))
        known = self.values[at] == values if len(self.values) else np.zeros(len(values), bool)
        self.n[at[known]] += n[known]
        values, n = values[~known], n[~known]
        place = np.searchsorted(self.values, values)
        self.values, self.n = np.insert(self.values, place, values), np.insert(self.n, place, n)

    def result(self) -> tuple[int, int]:
        """How many values there are, and how often the most frequent occurs."""
        self.merge()
        return len(self.n), int(self.n.max(initial=0))


def _long_statistics(data: np.ndarray) -> np.ndarray:
    """The statistics of one long text, piece by piece: what is held are the distinct hashes of words, triples and lines."""
    count, length, squares, twice = 0, 0.0, 0.0, 0
    words, threes, lines = _Counts(), _Counts(), _Counts()
    for piece, starts, ends, _, base in T.cut(data, T.NON_SPACE, 2):
        hashes, new = T.word_hashes(piece, starts, ends), 2 if base else 0
        sizes = (ends - starts)[new:].astype(float)
        count, length, squares = count + len(sizes), length + sizes.sum(), squares + (sizes**2).sum()
        twice += int((hashes[1:] == hashes[:-1])[max(0, new - 1) :].sum())
        words.add(hashes[new:])
        threes.add(T.rolling(hashes, 3))
    ends = np.append(np.flatnonzero(data == 10), len(data))
    n, held = 0, []
    for a, z in zip(np.append(0, ends[:-1] + 1).tolist(), ends.tolist(), strict=True):
        if z > a:
            held.append(xxhash.xxh64_intdigest(data[a:z].data))
        if len(held) >= T.PIECE or z == len(data):
            lines.add(np.array(held, dtype=np.uint64))
            n, held = n + len(held), []
    frequency = np.bincount(data, minlength=256) if len(data) <= T.PIECE else sum(np.bincount(x, minlength=256) for x in np.array_split(data, -(-len(data) // T.PIECE)))
    row = [len(data), count, (_MASKS @ frequency)[:, None], length, squares, *words.result(), twice, threes.result()[0], n, lines.result()[0]]
    return _summary(*[np.atleast_1d(np.asarray(x, dtype=float)) for x in row])[0]


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, x.T)], names=["doc_id", *STATISTICS])

    return map_batches(spread(pick(docs, "doc_id", "text")), run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


class Model:
    """Scale, projections, weights and calibration; picklable and of a fixed size."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.default_rng(20)
        d = len(mean)
        self.mean, self.deviation = mean, np.where(deviation > 1e-12, deviation, 1)
        self.project = rng.normal(size=(d, FOURIER)) / (WIDTH * np.sqrt(d))
        self.phase = rng.uniform(0, 2 * np.pi, FOURIER)
        self.weights = np.zeros(FOURIER + d + 1)
        self.without = np.zeros((FOLDS, FOURIER + d + 1))  # weights learnt without each fold
        self.knots: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.full(1, 0.5))

    def inputs(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.deviation, -6, 6)
        return np.concatenate([np.sqrt(2 / FOURIER) * np.cos(x @ self.project + self.phase), x, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        z = self.inputs(x)
        return np.clip(z @ self.weights if fold is None else np.einsum("ij,ij->i", z, self.without[fold]), LOW, HIGH)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators: a non-decreasing share for each bin with rows."""
    blocks: list[list[float]] = []
    for a, b in zip(n.tolist(), positive.tolist(), strict=True):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(k), b / a) for a, b, k in blocks]) if blocks else np.empty(0)


def _matrix(b: pa.RecordBatch, skip: int) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[skip:]], axis=1) if len(b) else np.zeros((0, len(STATISTICS)))


def _sums(found: dict[int, list]) -> Iterator[pa.RecordBatch]:
    for fold, (n, total) in sorted(found.items()):
        yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["fold", "n", "sums"])


def _solved(total: np.ndarray, n: int) -> np.ndarray:
    penalty = np.full(len(total), RIDGE * n)
    penalty[-1] = 1e-9
    return np.linalg.solve(total[:, :-1] + np.diag(penalty + 1e-9), total[:, -1])


def learn(stats: DataFrame, labelled: DataFrame) -> Model:
    """A model of `labelled` (quality 0 or 1, fold, then the statistics); `stats`, of all documents, gives the scale."""
    scale = stats.agg(*[F.avg(s) for s in STATISTICS], *[F.stddev_pop(s) for s in STATISTICS]).first()
    values = np.array([v or 0.0 for v in scale], dtype=float)
    model = Model(values[: len(STATISTICS)], values[len(STATISTICS) :])
    width = len(model.weights)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            z, y, fold = model.inputs(_matrix(b, 2)), b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy()
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                at = found.setdefault(f, [0, np.zeros((width, width + 1))])
                at[0] += len(own)
                at[1] += own.T @ np.concatenate([own, y[fold == f][:, None]], axis=1)
        yield from _sums(found)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            for fold, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                at = found.setdefault(fold, [0, np.zeros((width, width + 1))])
                at[0] += n
                at[1] += np.frombuffer(x.as_buffer()).reshape(width, width + 1)
        yield from _sums(found)

    kind = "fold int, n long, sums binary"
    totals, n = np.zeros((FOLDS, width, width + 1)), np.zeros(FOLDS, np.int64)
    for fold, k, x in map_batches(map_batches(labelled, sums, kind).repartition(8), added, kind).toLocalIterator():  # at most eight rows a fold
        totals[fold] += np.frombuffer(bytes(x)).reshape(width, width + 1)
        n[fold] += k
    if not n.sum():
        return model
    model.weights = _solved(totals.sum(axis=0), n.sum())
    for fold in range(FOLDS):  # a fold that holds all rows has none to learn from but its own
        rest = n.sum() - n[fold]
        model.without[fold] = _solved(totals.sum(axis=0) - totals[fold], rest) if rest else model.weights

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = model.raw(_matrix(b, 2), b.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(_bin(raw)), b.column(0)], names=["bin", "quality"])

    bins = map_batches(labelled, binned, "bin int, quality int").groupBy("bin").agg(F.count("quality").alias("n"), F.sum("quality").alias("good")).orderBy("bin").collect()  # at most BINS rows
    at, n, good = (np.array([r[i] for r in bins], dtype=float) for i in range(3))
    model.knots = (LOW + (at + 0.5) * (HIGH - LOW) / BINS, isotonic(n, good))
    return model


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int32), BINS - 1)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Learnt from the labels of rows whose crc32 of doc_id as text isn't 1 modulo 3; labels
    other than 0 and 1 or without doc_id are left out, repeated ones count again.  Null
    texts count as empty and have a score too; without any label every score is 0.5.  Null
    ids and repeated rows pass through.
    """
    stats = written(features(docs), "statistics")
    known = pick(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out(3, 1)).withColumn("quality", F.col("quality").cast("int"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = written(stats.join(known, "doc_id").select("quality", fold, *STATISTICS), "labelled")
    shared = docs.sparkSession.sparkContext.broadcast(learn(stats, labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(_matrix(b, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    found = map_batches(stats, run, "doc_id long, score double, predicted int")
    return found.select("doc_id", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"), "score", "predicted")
