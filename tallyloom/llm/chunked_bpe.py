"""Byte-pair encoding by content-defined chunks, and decoding.

A rolling hash over the last 32 bytes cuts each whole text where some of its bits are zero, so texts that
share a passage share the chunks inside it, wherever the passage stands.  A worker encodes each
chunk once, word by word, and keeps its ids.  A chunk's first and last words may be torn by the cuts; at every
joint a window from the last whole word of the chunk before to the first whole word of the
chunk after is encoded again.  The window must give those two words exactly the ids that their
chunks gave them; where it does not, it grows over the next chunk and is encoded again.  Chunks
without two whole words of their own lie inside a window altogether, so each part of a text is
in one window at most per round, also in texts without white space.

Why agreement suffices: the tokenizer drops white space and splits there before it merges, its
special tokens hold none, and its normal form joins no character to a space or newline before
it.  Ids on both sides of a white-space cut are therefore independent of each other.

The library's file gives vocabulary, merges, normal form and special tokens, whose names inside
a text are special tokens, as a plain call of the library has it.  Truncation and padding are
off.  Decoding joins the tokens' strings by a space if the file names no decoder, and else asks the library.

The store of chunks only saves time: two generations of bounded size, the older one forgotten.

Defined cases: null and empty texts have no ids and decode to an empty text; repeated rows are
rows of their own; only the id and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pretokens import id_lists, slices

# Chunks have 2^CUT_BITS bytes on average; the hash sees 2^_DOUBLINGS bytes.
CUT_BITS = 9
_DOUBLINGS = 5
# Characters in one generation of the store, beside the words a worker keeps.
STORE_CHARS = 12_000_000
STORE_WORDS = 1_000_000
SLICE_CHARS = 2_000_000

_NONE = np.zeros(0, np.int32)

Encode = Callable[[Sequence[str]], Iterable[Sequence[int]]]


def _gear() -> np.ndarray:
    """A fixed, well mixed number for every byte value."""
    value = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (value >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def cut(data: bytes, bits: int = CUT_BITS) -> list[int]:
    """Ends of a text's chunks: after bytes where the rolling hash's top bits are 0 and a character ends."""
    if not data:
        return []
    octets = np.frombuffer(data, np.uint8)
    rolling = _GEAR[octets]
    for doubling in range(_DOUBLINGS):
        # The sum over 2 w bytes is the one over w bytes and the one before it, shifted by w.
        width = 1 << doubling
        rolling[width:] += rolling[:-width] << np.uint32(width)
    places = np.flatnonzero(rolling[:-1] >> np.uint32(32 - bits) == 0) + 1
    return [*places[octets[places] & 0xC0 != 0x80].tolist(), len(data)]


class Chunk(NamedTuple):
    """A chunk's ids, its torn ends, and the first and last words it holds whole; none if it has no two."""

    text: str
    ids: np.ndarray
    # Torn start and first whole word; ids of both, and of the word alone.  The same from the end.
    opening: str | None = None
    n_opening: int = 0
    n_lead: int = 0
    closing: str = ""
    n_closing: int = 0
    n_trail: int = 0

    def lead(self) -> np.ndarray:
        return self.ids[self.n_opening - self.n_lead : self.n_opening]

    def trail(self) -> np.ndarray:
        start = len(self.ids) - self.n_closing
        return self.ids[start : start + self.n_trail]


class Words:
    """Numbers of words as they appear, and the ids of each, encoded once while the store is not full."""

    def __init__(self, encode: Encode, limit: int = STORE_WORDS):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._codes: dict[str, int] = {}
        self._ids = np.zeros(0, np.int32)
        self._ends = np.zeros(1, np.int64)

    def __call__(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after the other, and where each word's ids end, from 0 on."""
        if len(self._codes) > self._limit:
            self._clear()
        codes, known = self._codes, len(self._codes)
        found = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
        if len(codes) > known:
            encoded = list(self._encode(list(islice(codes, known, None))))
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum()))
            self._ids = np.concatenate([self._ids, ids])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(lengths)])
        start, stop = self._ends[found], self._ends[found + 1]
        ends = np.concatenate([[0], np.cumsum(stop - start)])
        places = np.repeat(start - ends[:-1], stop - start) + np.arange(ends[-1])
        return self._ids[places], ends


class ChunkEncoder:
    """Encodes slices of texts; ``encode`` must give texts cut at white space independent ids."""

    def __init__(self, encode: Encode, bits: int = CUT_BITS, store_chars: int = STORE_CHARS):
        self._encode, self._bits, self._limit = encode, bits, store_chars
        self._words = Words(encode)
        self._young: dict = {}
        self._old: dict = {}
        self._held = 0
        # For tests: chunks met and encoded, windows that did not agree at once.
        self.met = self.encoded = self.widened = 0

    def __call__(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of every text."""
        chunked = []
        for text in texts:
            data = (text or "").encode()
            ends = cut(data, self._bits)
            chunked.append([data[a:b] for a, b in zip([0, *ends], ends)])
        chunks = self._chunks(chunked)
        # Per text the chunks that stand for themselves; the others lie inside windows.
        standing = [[n for n, c in enumerate(own) if c.opening is not None] for own in chunks]
        windows: list[dict] = [{} for _ in texts]
        open_ = [n for n, own in enumerate(chunks) if own]
        while open_:
            asked = []
            for n in open_:
                for joint in _joints(standing[n], len(chunks[n])):
                    if joint not in windows[n]:
                        asked.append((n, joint, _window(chunks[n], *joint)))
            found = self._windows({text for _, _, text in asked})
            failed: dict[int, set] = {}
            for n, (left, right), text in asked:
                ids, own = found[text], chunks[n]
                windows[n][left, right] = ids
                if not _agrees(ids, own[left].trail() if left >= 0 else _NONE, own[right].lead() if right < len(own) else _NONE):
                    # Over the next chunk, or back over the one before where the text ends.
                    failed.setdefault(n, set()).add(right if right < len(own) else left)
                    self.widened += 1
            for n, gone in failed.items():
                standing[n] = [k for k in standing[n] if k not in gone]
            open_ = list(failed)
        return [_joined(own, kept, found) for own, kept, found in zip(chunks, standing, windows)]

    def _chunks(self, chunked: list[list[bytes]]) -> list[list[Chunk]]:
        """The chunks of all texts; those not in store are encoded, each once."""
        known: dict[bytes, Chunk | None] = {}
        for own in chunked:
            for data in own:
                if data not in known:
                    known[data] = self._look(data)
            self.met += len(own)
        new = [data for data, chunk in known.items() if chunk is None]
        texts = [data.decode() for data in new]
        parts = [text.replace("\n", " ").split(" ") for text in texts]
        ids, ends = self._words([word for words in parts for word in words])
        at = 0
        for data, text, words in zip(new, texts, parts):
            # Ends of the words' ids; empty words stand between white space and have none.
            cuts = ends[at : at + len(words) + 1]
            at += len(words)
            first, last = 1, len(words) - 2
            while first < last and not words[first]:
                first += 1
            while first < last and not words[last]:
                last -= 1
            chunk = Chunk(text, ids[cuts[0] : cuts[-1]])
            if first < last:
                chunk = chunk._replace(
                    opening=f"{words[0]} {words[first]}", n_opening=int(cuts[first + 1] - cuts[0]),
                    n_lead=int(cuts[first + 1] - cuts[first]), closing=f"{words[last]} {words[-1]}",
                    n_closing=int(cuts[-1] - cuts[last]), n_trail=int(cuts[last + 1] - cuts[last]),
                )
            known[data] = chunk
            # A copy: a slice would keep the ids of the whole call.
            self._keep(data, chunk._replace(ids=chunk.ids.copy()), len(text))
        self.encoded += len(new)
        return [[known[data] for data in own] for own in chunked]

    def _windows(self, texts: set[str]) -> dict[str, np.ndarray]:
        found = {text: self._look(text) for text in texts}
        new = [text for text, ids in found.items() if ids is None]
        for text, ids in zip(new, self._encode(new)):
            found[text] = np.asarray(ids, np.int32)
            self._keep(text, found[text], len(text))
        return found

    def _look(self, key):
        value = self._young.get(key)
        if value is None:
            value = self._old.get(key)
            if value is not None:
                self._keep(key, value, len(key))
        return value

    def _keep(self, key, value, chars: int) -> None:
        self._held += chars + 100
        self._young[key] = value
        if self._held > self._limit:
            self._old, self._young, self._held = self._young, {}, 0


def _joints(standing: list[int], n: int) -> Iterator[tuple[int, int]]:
    """Pairs of chunks with a window between them; -1 and n stand for the text's start and end."""
    if not standing:
        yield -1, n
        return
    if standing[0] > 0:
        yield -1, standing[0]
    yield from zip(standing, standing[1:])
    if standing[-1] < n - 1:
        yield standing[-1], n


def _window(chunks: list[Chunk], left: int, right: int) -> str:
    return "".join(
        [
            chunks[left].closing if left >= 0 else "",
            *(c.text for c in chunks[left + 1 : right]),
            chunks[right].opening if right < len(chunks) else "",
        ]
    )


def _agrees(ids: np.ndarray, trail: np.ndarray, lead: np.ndarray) -> bool:
    n = len(ids)
    return (
        n >= len(trail) + len(lead)
        and np.array_equal(ids[: len(trail)], trail)
        and np.array_equal(ids[n - len(lead) :], lead)
    )


def _joined(chunks: list[Chunk], standing: list[int], windows: dict) -> np.ndarray:
    if not chunks:
        return np.zeros(0, np.int32)
    if not standing:
        return windows[-1, len(chunks)]
    out = []
    first, last = standing[0] > 0, standing[-1] < len(chunks) - 1
    if first:
        out.append(windows[-1, standing[0]])
    for place, number in enumerate(standing):
        chunk = chunks[number]
        # The ends that a window covers are the window's.
        a = chunk.n_opening if place or first else 0
        b = len(chunk.ids) - (chunk.n_closing if place < len(standing) - 1 or last else 0)
        out.append(chunk.ids[a:b])
        if place < len(standing) - 1:
            out.append(windows[number, standing[place + 1]])
    if last:
        out.append(windows[standing[-1], len(chunks)])
    return np.concatenate(out)


class _Library:
    """The tokenizer of a file and its chunks; tokens decode as the file says."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._tokenizer = tokenizer
        with open(path, encoding="utf-8") as file:
            self._joined_by_space = json.load(file)["decoder"] is None
        self.encoder = ChunkEncoder(self.plain)
        self.tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]

    def plain(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        if self._joined_by_space:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self._tokenizer.decode(ids.tolist(), skip_special_tokens=False)


@lru_cache(maxsize=1)
def _library(path: str) -> _Library:
    return _Library(path)


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id") -> DataFrame:
    """(id, ids) for every row's ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _library(tokenizer).encoder
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                found = encoder(texts)
                lists = id_lists(np.concatenate(found), np.cumsum([len(ids) for ids in found]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), lists], [id_column, "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str, id_column: str = "doc_id") -> DataFrame:
    """(id, decoded) for every row's ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(tokenizer)
        for batch in batches:
            decoded = [library.decode(np.asarray(row.as_py() or [], np.int32)) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.string())], [id_column, "decoded"])

    kind = tokens.schema[id_column].dataType.simpleString()
    return tokens.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids count as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(tokenizer)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                found = library.encoder(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(ids) for ids in found], pa.int64()),
                        pa.array([hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in found]),
                        pa.array([hashlib.sha256(library.decode(ids).encode()).hexdigest() for ids in found]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
