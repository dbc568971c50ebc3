"""Vectorised text kernels over Arrow string buffers.

Words are found and hashed straight on the UTF-8 bytes of a whole batch, so no
Python object is made per word.  Every function treats null texts as empty.  Long texts
are worked on piece by piece, so what a kernel holds doesn't grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
#: Words longer than this many bytes are hashed by XXH64 instead of the rolling polynomial.
LONG_WORD = 64
#: Bytes of a run of rows; a longer text is cut in pieces of about so many bytes and at most so many words.
PIECE = 1 << 18
#: Values that are hashed at once.
BLOCK = 1 << 17


def _classes(outside: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


#: Bytes of words `[^\x20\x09-\x0D]+`.
NON_SPACE = _classes(bytes([0x20, *range(0x09, 0x0E)]))
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z became a-z.
ALNUM = _classes(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Lower-cases A-Z and leaves every other byte alone.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets at which they start and end."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about PIECE bytes; one longer text is a run of its own."""
    data, offsets = buffers(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def long(data: np.ndarray, offsets: np.ndarray) -> bool:
    """Whether a run is one text that is longer than a piece."""
    return len(offsets) == 2 and len(data) > PIECE


def pieces(texts: pa.Array, inside: np.ndarray, overlap: int = 0, table: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int | None]]:
    """(first row, bytes, starts, ends, first, base) of runs of rows, with their words as `words` gives them.

    Bytes are translated by `table`.  A long text comes in several pieces, cut between
    words: `base`, else None, counts the words of the text before the piece; if it isn't 0
    the piece begins with the last `overlap` words of the one before.
    """
    for row, data, offsets in slices(texts):
        if long(data, offsets):
            for piece in cut(data, inside, overlap, table):
                yield row, *piece
        else:
            data = data if table is None else table[data]
            yield row, data, *words(data, offsets, inside), None


def cut(data: np.ndarray, inside: np.ndarray, overlap: int, table: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, starts, ends, first, base) of the pieces of one text."""
    at, base, step = 0, 0, PIECE
    while True:
        stop = min(len(data), at + step)
        while stop < len(data):  # to the end of the word
            ahead = data[stop : stop + PIECE]
            out = np.flatnonzero(~inside[ahead if table is None else table[ahead]])
            stop += int(out[0]) if len(out) else len(ahead)
            if len(out):
                break
        piece = data[at:stop] if table is None else table[data[at:stop]]
        starts, ends, first = words(piece, np.array([0, len(piece)]), inside)
        most = PIECE + overlap
        if len(starts) > most:
            piece, stop = piece[: starts[most]], at + int(starts[most])
            starts, ends, first = starts[:most], ends[:most], np.array([0, most])
        if stop < len(data) and len(starts) <= overlap:
            step *= 2
            continue
        yield piece, starts, ends, first, base
        if stop == len(data):
            return
        base += len(starts) - overlap
        at, step = at + int(starts[len(starts) - overlap]) if overlap else stop, PIECE


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all rows, and for each row its first word's index (n + 1 values)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    member = inside[data]
    before, after = np.empty_like(member), np.empty_like(member)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = member[:-1], member[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the splitmix64 constants)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=4)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**j and base**-j modulo 2**64 for j < 2 * BLOCK; base is odd."""

    def run(b: int) -> np.ndarray:
        out = np.ones(1, dtype=U64)
        step = b
        while len(out) < 2 * BLOCK:
            out = np.concatenate([out, out * U64(step)])
            step = step * step % (1 << 64)
        return out

    return run(base), run(pow(base, -1, 1 << 64))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def _sums(values: np.ndarray) -> np.ndarray:
    total = np.empty(len(values) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(values, out=total[1:])
    return total


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    up, down = _powers(_BASES[0])
    out = np.empty(len(starts), dtype=U64)
    for at in range(0, len(data), BLOCK):
        i, j = np.searchsorted(starts, [at, at + BLOCK])
        if i < j:
            some = data[at : at + BLOCK + LONG_WORD]
            total = _sums(_BYTE[some] * up[: len(some)])
            a, z = starts[i:j] - at, ends[i:j] - at
            out[i:j] = mix((total[np.minimum(z, a + LONG_WORD)] - total[a]) * down[a])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 7)
    return out


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of every `width` consecutive values; `which` 0 and 1 are independent.  Runs over row ends too."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = _powers(_BASES[which])
    values = mix(hashes ^ U64(0x8000000000000001)) if which else hashes
    out = np.empty(n, dtype=U64)
    for at in range(0, n, BLOCK):
        some = values[at : at + BLOCK + width - 1]
        total = _sums(some * up[: len(some)])
        m = len(some) - width + 1
        out[at : at + m] = mix((total[width:] - total[:m]) * down[:m])
    return out


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """np.minimum or np.maximum of every `width` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of n positions that lie in [s, s + width) for some s of starts."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + width, n), -1)
    return np.cumsum(delta[:-1]) > 0


_P = tuple(U64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def _round(lane: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _turn(lane + value * _P[1], 31) * _P[0]


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64, by its published specification, of every data[start:end]; long ones go to the library."""
    sizes = ends - starts
    out = np.empty(len(starts), dtype=U64)
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    # the 8 and 4 bytes from any place on, little-endian
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 8,), (1,))
    four = np.lib.stride_tricks.as_strided(padded[:4].view("<u4"), (len(data) + 12,), (1,))
    far = sizes > 4 * LONG_WORD
    for i in np.flatnonzero(far):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    order = np.flatnonzero(~far)
    order = order[np.argsort(sizes[order], kind="stable")]  # by length, so that what is still unfinished is a tail
    at, left = starts[order], sizes[order]
    with np.errstate(over="ignore"):
        h = np.full(len(order), U64(seed) + _P[4], dtype=U64)
        long = int(np.searchsorted(left, 32))
        if long < len(order):
            lanes = [np.full(len(order) - long, x, dtype=U64) for x in (U64(seed) + _P[0] + _P[1], U64(seed) + _P[1], U64(seed), U64(seed) - _P[0])]
            a, stripes = at[long:], left[long:] // 32
            for k in range(int(stripes[-1])):
                i = int(np.searchsorted(stripes, k, side="right"))
                for lane, x in enumerate(lanes):
                    x[i:] = _round(x[i:], eight[a[i:] + (32 * k + 8 * lane)])
            total = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for x in lanes:
                total = (total ^ _round(np.zeros_like(x), x)) * _P[0] + _P[3]
            h[long:] = total
        h += left.astype(U64)
        at, left = at + left // 32 * 32, left % 32
        for k in range(3):
            i = np.flatnonzero(left >= 8 * (k + 1))
            h[i] = _turn(h[i] ^ _round(np.zeros(len(i), U64), eight[at[i] + 8 * k]), 27) * _P[0] + _P[3]
        at, left = at + left // 8 * 8, left % 8
        i = np.flatnonzero(left >= 4)
        h[i] = _turn(h[i] ^ (four[at[i]].astype(U64) * _P[0]), 23) * _P[1] + _P[2]
        at, left = at + left // 4 * 4, left % 4
        for k in range(3):
            i = np.flatnonzero(left > k)
            h[i] = _turn(h[i] ^ (padded[at[i] + k].astype(U64) * _P[4]), 11) * _P[0]
        h = (h ^ (h >> U64(33))) * _P[1]
        h = (h ^ (h >> U64(29))) * _P[2]
        out[order] = h ^ (h >> U64(32))
    return out
