"""Token ids and counts by the tokenizers library, each distinct piece of text encoded once.

A batch of texts is cut, on its bytes, at places that no token crosses: where one of letters,
digits and punctuation ends and another begins, before a single space and around a single
line feed; for `word_bpe_49k.json`, which drops white space, before any of it.  Nothing is
copied for that: Arrow counts the pieces as slices of the batch, and gathers the ids of all
from those of the distinct ones.  Pieces that aren't in a bounded memo go to the library,
many at once: a word of Latin letters straight to its BPE model, as the one pre-token
that it is, any other piece through the whole pipeline.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

#: The memo holds up to twice so many pieces, together about 200 MB.
MEMO = 400_000
#: Pieces longer than this are encoded but not kept.
LONG = 64
#: Bytes of a batch, and characters of a longer text, that are worked on at once, as far as there are places to cut.
CHUNK = 1 << 20
#: Bytes that are cut at once, and words that the BPE model gets at once.
WINDOW, WORDS = 1 << 18, 500

_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"  # letters that are their own NFC form


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()

#: Classes of bytes.  No cut is made beside a control character or, but for spaces, beside OTHER.
_CONTROL, _LETTER, _DIGIT, _POINT, _QUOTE, _SPACE, _LINE, _OTHER = range(8)


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, np.uint8)
    table[:0x80] = _CONTROL
    table[0x21:0x7F] = _POINT
    for first, last, kind in (("0", "9", _DIGIT), ("A", "Z", _LETTER), ("a", "z", _LETTER), ("'", "'", _QUOTE), (" ", " ", _SPACE), ("\n", "\n", _LINE)):
        table[ord(first) : ord(last) + 1] = kind
    return table


_CLASS = _class_table()


def _cut_table(keeps_spaces: bool) -> np.ndarray:
    """Whether to cut between two neighbours of classes a and b, at [a * 8 + b].

    After an apostrophe nothing is cut, as it and the letters behind it can be one token.
    """
    table = np.zeros((8, 8), bool)
    for a in (_LETTER, _DIGIT, _POINT):
        for b in (_LETTER, _DIGIT, _POINT, _QUOTE):
            table[a, b] = a != b and (a, b) != (_POINT, _QUOTE)
    if not keeps_spaces:
        table[_DIGIT, _DIGIT] = True  # each digit is a token
        table[:, _SPACE] = True
        table[_SPACE, _SPACE] = False
    return table.ravel()


_SOLID = np.isin(np.arange(8), [_LETTER, _DIGIT, _POINT, _QUOTE, _OTHER])


def _odd_pairs() -> tuple[np.ndarray, np.ndarray]:
    """By two bytes: whether they can begin, and whether they can end, white space outside ASCII (or what some tables count as such)."""
    begin, end = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
    for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF):
        raw = chr(c).encode()
        begin[raw[0] << 8 | raw[1]] = end[raw[-2] << 8 | raw[-1]] = True
    return begin, end


_ODD_BEGIN, _ODD_END = _odd_pairs()
#: For vocabularies that drop white space: all of ASCII's is a space; and lower case too.
_TO_SPACE = bytes(0x20 if b in b"\t\n\v\f\r" else b for b in range(256))
_TO_LOWER = _TO_SPACE.lower()


class Memo:
    """Ids by piece, in two generations: when the younger is full it becomes the older, and what is used again moves back."""

    def __init__(self, most: int):
        self.most = most
        self.younger: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def find(self, keys: list[bytes], learn: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """What is known of the (different) keys, the others from `learn`."""
        out = list(map(self.younger.get, keys))
        lack = [i for i, ids in enumerate(out) if ids is None]
        if self.older:
            for i in lack:
                out[i] = self.older.get(keys[i])
            new = [i for i in lack if out[i] is None]
        else:
            new = lack
        for i, ids in zip(new, learn([keys[i] for i in new]), strict=True):
            out[i] = ids
        for i in lack:
            if len(keys[i]) <= LONG:
                if len(self.younger) >= self.most:
                    self.younger, self.older = {}, self.younger
                self.younger[keys[i]] = out[i]
        return out


class Encoder:
    """Ids of texts, as little-endian arrays of `dtype`."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.keeps_spaces = bool(self.library.encode(" ", add_special_tokens=False).ids)
        self.cut_table = _cut_table(self.keeps_spaces)
        self.marks = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        # a piece that is one pre-token; and where a text can be cut, whatever its white space and marks
        self.simple = re.compile(f" ?(?:[{_LATIN}]+|[0-9]+)" if self.keeps_spaces else f" *[{_LATIN}]+")
        self.safe = re.compile("(?<=[0-9A-Za-z])(?= [0-9A-Za-z])|(?<=[A-Za-z])(?=[0-9.,;:!?])" + ("" if self.keeps_spaces else "|(?<=[0-9])(?=[0-9])"))
        self.words = Tokenizer(self.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        (self.between,) = (t.id for t in self.model.tokenize("!"))
        self.memo = Memo(MEMO)

    def _window(self, data: np.ndarray) -> np.ndarray:
        """A mask of the places before which data can be cut."""
        kind = _CLASS[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))  # U+00C0 to U+017F
        if len(lead):
            lead = lead[lead + 1 < len(data)]
            first, second = data[lead], data[lead + 1]
            # two are not letters, and a third has no small form that is one
            lead = lead[((first != 0xC3) | ((second | 0x20) != 0xB7)) & ((first != 0xC4) | (second != 0xB0))]
            kind[lead] = kind[lead + 1] = _LETTER
        cut = np.zeros(len(data), bool)
        cut[1:] = self.cut_table[kind[:-1] << 3 | kind[1:]]
        if self.keeps_spaces:
            at = np.flatnonzero((kind == _SPACE) | (kind == _LINE))
            at = at[(at > 1) & (at < len(data) - 2)]
            before, after = kind[at - 1], kind[at + 1]
            ok = _SOLID[before] & _SOLID[after]
            if (before == _OTHER).any() or (after == _OTHER).any():
                wide = data.astype(np.uint16)
                ok &= (before != _OTHER) | ~_ODD_END[wide[at - 2] << 8 | wide[at - 1]]
                ok &= (after != _OTHER) | ~_ODD_BEGIN[wide[at + 1] << 8 | wide[at + 2]]
            at = at[ok]
            cut[at] = True
            cut[at[kind[at] == _LINE] + 1] = True
        return cut

    def _places(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of rows start, and the end of the last."""
        data, n = np.frombuffer(raw, np.uint8), len(raw)
        cut = np.empty(n + 1, bool)
        for at in range(0, n, WINDOW):
            low, stop = max(0, at - 4), min(n, at + WINDOW)
            cut[at:stop] = self._window(data[low : stop + 4])[at - low : stop - low]
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                cut[at + 1 : at + len(mark)] = False
                at = raw.find(mark, at + 1)
        cut[offsets] = True
        return np.flatnonzero(cut)

    def _learn(self, keys: list[bytes]) -> list[bytes]:
        """The ids of pieces that aren't in the memo."""
        out: list[bytes] = [b""] * len(keys)
        words, at, others, others_at = [], [], [], []
        for i, key in enumerate(keys):
            piece = key.decode()
            if self.simple.fullmatch(piece):
                if not self.keeps_spaces:
                    piece = piece.lstrip(" ").lower()
                words.append(piece.replace(" ", _LETTERS[0x20]) if piece.isascii() else piece.encode().decode("latin-1").translate(_LETTERS))
                at.append(i)
            else:
                others.append(piece)
                others_at.append(i)
        width = self.dtype.itemsize
        taken = iter(at)
        for i in range(0, len(words), WORDS):  # what the library returns is large
            (line,) = self.words.encode_batch_fast([" ! ".join(words[i : i + WORDS]) + " !"], add_special_tokens=False)
            ids = np.array(line.ids, dtype=self.dtype)
            raw, start = ids.tobytes(), 0
            for stop in (np.flatnonzero(ids == self.between) * width).tolist():  # no word has that token
                out[next(taken)] = raw[start:stop]
                start = stop + width
        assert next(taken, None) is None
        for i in range(0, len(others), WORDS):
            some = self.library.encode_batch_fast(others[i : i + WORDS], add_special_tokens=False)
            for k, e in zip(others_at[i : i + WORDS], some, strict=True):
                out[k] = np.array(e.ids, dtype=self.dtype).tobytes()
        return out

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        if offsets[-1] == offsets[0]:
            return np.empty(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        raw = data[offsets[0] : offsets[-1]].to_pybytes()
        offsets = offsets - offsets[0]
        if not self.keeps_spaces:
            # capitals of a special token's name, or under a combining mark (UTF-8 from CC and CD), are not the small letters
            raw = raw.translate(_TO_SPACE if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw else _TO_LOWER)
        places = self._places(raw, offsets)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64, copy=False)), pa.py_buffer(raw)]).dictionary_encode()
        _, at, distinct = pieces.dictionary.buffers()
        at, distinct = np.frombuffer(at, dtype=np.int64, count=len(pieces.dictionary) + 1).tolist(), distinct.to_pybytes()
        keys = [distinct[a:z] for a, z in pairwise(at)]
        ids = pa.array(self.memo.find(keys, self._learn), pa.large_binary()).take(pieces.indices)
        _, at, values = ids.buffers()
        at = np.frombuffer(at, dtype=np.int64)[np.searchsorted(places, offsets)] // self.dtype.itemsize
        return np.frombuffer(values, self.dtype, count=int(at[-1])), at

    def arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the n + 1 places at which those of each start and end; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        long = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > CHUNK)
        if not len(long):
            return self._run(texts)
        ids, sizes, row = [], [], 0
        for i in [*long.tolist(), len(texts)]:
            some, at = self._run(texts.slice(row, i - row))
            ids.append(some)
            sizes.append(np.diff(at))
            if i < len(texts):
                chunks = [self._run(pa.array([c], pa.large_string()))[0] for c in _chunks(texts[i].as_py(), self.safe)]
                ids += chunks
                sizes.append(np.array([sum(map(len, chunks))]))
            row = i + 1
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As `arrays`, with end_id after each text."""
        ids, at = self.arrays(texts)
        return np.insert(ids, at[1:], end_id), at + np.arange(len(at))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of `dtype`."""
        ids, at = self.arrays(pa.array(texts, pa.large_string()))
        return [ids[a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)]


def _chunks(text: str, safe: re.Pattern) -> Iterable[str]:
    """A long text in parts that no token spans."""
    at = 0
    while at < len(text):
        m = safe.search(text, at + CHUNK)
        stop = m.start() if m else len(text)
        yield text[at:stop]
        at = stop


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file; a worker keeps one at a time."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Frees the encoders and their memos."""
    _encoders.clear()


def path(name: str) -> str:
    """Where a vocabulary file lies on this machine."""
    return public_tokenizers.path(name)


def balanced(texts: pa.Array, most: int = 2 << 20) -> Iterable[tuple[int, pa.Array]]:
    """(first row, texts) of runs of about `most` bytes; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row, n = 0, len(texts)
    while row < n:
        base = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield row, texts.slice(row, end - row)
        row = end
