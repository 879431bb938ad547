"""Cutting texts into stretches that a byte-level tokenizer encodes independently of each other.

The tokenizers used here first cut a text by a pattern whose matches never join a non-space
character to white space after it.  A stretch from a space that follows a non-space up to the
next such space is therefore cut the same way alone as inside its text, and so is a single
newline between non-spaces.  Such stretches repeat a lot; each is encoded once per worker and
its ids are reused.  A stretch that is a word of letters and one mark is put together from the
ids of both.  The cache only saves time: when it is full, stretches used rarely are forgotten
and encoded again when they come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

# A full cache takes about 150 MB of a worker.
CACHE_UNITS = 850_000
# Texts are worked on in slices of about so many characters.
SLICE_CHARS = 2_000_000

# A space after white space, or white space that is neither a space nor a newline.
_IRREGULAR = ("  ", "\n ", *map(chr, (9, 11, 12, 13, *range(28, 32), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

_MARKS = frozenset(",.;:!?")
_NEWLINE = ("\n",)

Encode = Callable[[Sequence[str]], Iterable[Sequence[int]]]


class UnitEncoder:
    """Encodes slices of texts; ``encode`` turns new stretches into ids, ``cut`` cuts irregular texts."""

    def __init__(self, encode: Encode, cut: Callable[[str], Sequence[str]], limit: int = CACHE_UNITS):
        self._encode, self._cut, self._limit = encode, cut, limit
        self._clear()

    def _clear(self) -> None:
        self._codes = _Codes()
        self._flat = np.zeros(0, np.int32)
        self._start = np.zeros(0, np.int64)
        self._length = np.zeros(0, np.int64)
        self._used = np.zeros(0, np.int64)

    def _units(self, text: str) -> list:
        """Keys of a text's stretches: a string stands for a space and itself, a tuple for exactly its text."""
        if not text:
            return []
        if any(mark in text for mark in _IRREGULAR):
            return [(part,) for part in self._cut(text)]
        if "\n" not in text:
            return _line_units(text)
        if "\n\n" in text or " \n" in text or text[-1] == " ":
            return _line_units(text)
        keys: list = []
        for number, line in enumerate(text.split("\n")):
            if number:
                keys.append(_NEWLINE)
            if line:
                keys += _line_units(line)
        return keys

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids end."""
        look, codes, ends = self._codes.__getitem__, [], []
        for text in texts:
            keys = self._units(text or "")
            codes.append(np.fromiter(map(look, keys), np.int64, len(keys)))
            ends.append(len(keys))
        self._learn()
        found = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        self._used += np.bincount(found, minlength=len(self._used))
        lengths = self._length[found]
        total = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(self._start[found] - total[:-1], lengths) + np.arange(total[-1])
        ids = self._flat[places]
        if len(self._codes) > self._limit:
            self._forget()
        return ids, total[np.cumsum(ends)] if ends else np.zeros(0, np.int64)

    def _learn(self) -> None:
        new, whole, joined = self._codes.new, [], []
        if not new:
            return
        first = len(self._start)
        for number, key in enumerate(new):  # grows while it is read
            mark = key[-1] if isinstance(key, str) and len(key) > 1 else ""
            if mark in _MARKS and key[:-1].isalpha() and max(key) < "\u0250":
                joined.append((number, self._codes[key[:-1]], self._codes[(mark,)]))
            else:
                whole.append(number)
        encoded = list(self._encode([_text(new[n]) for n in whole]))
        length = np.zeros(len(new), np.int64)
        length[whole] = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(length.sum()))
        start = np.zeros(len(new), np.int64)
        start[whole] = len(self._flat) + np.cumsum(length[whole]) - length[whole]
        self._flat = np.concatenate([self._flat, ids])
        self._start = np.concatenate([self._start, start])
        self._length = np.concatenate([self._length, length])
        self._used = np.concatenate([self._used, np.zeros(len(new), np.int64)])
        if joined:
            at, word, mark = np.array(joined).T
            at = at + first
            parts = np.stack([word, mark], 1).ravel()
            sizes = self._length[parts]
            ends = np.cumsum(sizes)
            places = np.repeat(self._start[parts] - (ends - sizes), sizes) + np.arange(ends[-1])
            both = sizes.reshape(-1, 2).sum(axis=1)
            self._start[at] = len(self._flat) + np.cumsum(both) - both
            self._length[at] = both
            self._flat = np.concatenate([self._flat, self._flat[places]])
        new.clear()

    def _forget(self) -> None:
        """Keep the stretches used most often, at most half as many as the cache holds."""
        least = max(2, int(np.partition(self._used, -(self._limit // 2 + 1))[-(self._limit // 2 + 1)]) + 1)
        kept = self._used >= least
        keys = [k for k, keep in zip(self._codes, kept.tolist()) if keep]
        length, start, used = self._length[kept], self._start[kept], self._used[kept]
        ends = np.cumsum(length)
        places = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        flat = self._flat[places]
        self._codes = _Codes(zip(keys, range(len(keys))))
        self._flat, self._start, self._length, self._used = flat, ends - length, length, used


class _Codes(dict):
    """Numbers keys as they appear and remembers the new ones."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = code = len(self)
        self.new.append(key)
        return code


def _line_units(line: str) -> list:
    keys: list = line.split(" ")
    if keys[0]:
        keys[0] = (keys[0],)
    else:
        del keys[0]
    return keys


def _text(key) -> str:
    return key[0] if isinstance(key, tuple) else " " + key


def slices(column: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, list]]:
    """(first row, texts) for stretches of a column that hold about ``chars`` characters."""
    first, texts, held = 0, [], 0
    for row in range(len(column)):
        text = column[row].as_py()
        texts.append(text)
        held += len(text or "")
        if held >= chars:
            yield first, texts
            first, texts, held = row + 1, [], 0
    if texts:
        yield first, texts


def id_lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32, copy=False)))
