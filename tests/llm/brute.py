"""Plain versions of the operators, row by row and pair by pair."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

SPACED = re.compile("[^\\x20\\x09-\\x0D]+")
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ids(vocabulary: str, text: str | None, end: int | None = None) -> list[int]:
    t = ids.of.get(vocabulary) or ids.of.setdefault(vocabulary, Tokenizer.from_file(public_tokenizers.path(vocabulary)))
    return t.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])


ids.of = {}


def crc(values: list[int]) -> int:
    return zlib.crc32(b"".join(v.to_bytes(4, "little") for v in values))


def contamination(docs: list[tuple], items: list[tuple]) -> dict:
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if of := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= of
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def substring(docs: list[tuple], width: int = 35) -> list[tuple]:
    """(doc_id, words, kept words) of every row."""
    words = [(d, SPACED.findall(t or "")) for d, t in docs]
    seen = Counter(tuple(w[i : i + width]) for _, w in words for i in range(len(w) - width + 1))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append((d, w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def fingerprint(text: str | None) -> int:
    w = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(prints: list[tuple[int, int]]) -> dict[int, int]:
    """doc_id -> smallest reachable doc_id."""
    parent = {d: d for d, _ in prints}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 3:
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: root(d) for d, _ in prints}
