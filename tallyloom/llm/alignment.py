"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode each whole text: a byte-level BPE file (A) the text after a space, a
SentencePiece model (B) the text, before which it sets that space itself.  Byte offsets where tokens of both end
cut them into groups; the two tokens that end there are linked.

The merge is in lockstep: one NumPy state vector holds, for every lane, the next token of A and
of B, and each step advances in all lanes the token that ends first, or both.  Lanes that meet
emit a link and a cut; finished lanes are compacted away.  A lane is a document, and a long
document is several: it is split at ends that both tokenizers share, so that the longest lane
bounds the number of steps.

Of two linked tokens the shorter one's bytes end the longer one's.  So no more pairs exist than
the two vocabularies have bytes, whatever the corpus: the table of pair counts has a fixed bound
and may be broadcast.  It is summed up in the tasks before it is shuffled.

Texts are encoded by stretches that are kept (``pretokens``); that a stretch is encoded the same
way alone is checked on the model's vocabulary when it is read.  A row whose bytes either
tokenizer does not give back (``U+2581`` in a text, say) has no tokens.

Defined cases: null and empty texts have no tokens; repeated rows are rows of their own, and
their links count each time; null ids are kept; ties for a B token's highest count are all best;
names of special tokens inside a text are plain text; an empty table gives empty tables; only
the id and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .pretokens import UnitEncoder, slices

# A lane has about so many tokens of A; lanes of a slice advance together.
LANE = 256
SLICE_CHARS = 300_000
CACHE_UNITS = 150_000
# Stretches given to a library in one call: its answers are large while they are held.
CALL_UNITS = 4096
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Side(NamedTuple):
    """A tokenizer: ids of stretches, and every id's bytes, flat and by where they end."""

    encode: Callable[[Sequence[str]], Iterator[list[int]]]
    data: np.ndarray
    ends: np.ndarray

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.ends[ids + 1] - self.ends[ids]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths(ids)
        stops = np.cumsum(lengths)
        places = np.repeat(self.ends[ids] - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)
        return self.data[places]


def _flat(tokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _calls(units: Sequence[str]) -> Iterator[list[str]]:
    for first in range(0, len(units), CALL_UNITS):
        yield list(units[first : first + CALL_UNITS])


def byte_side(path: str) -> Side:
    """A byte-level BPE file; encodes a text after a space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte = _byte_level()
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    tokens = [
        special[i] if i in special else bytes(byte[c] for c in tokenizer.id_to_token(i) or "")
        for i in range(tokenizer.get_vocab_size(with_added_tokens=True))
    ]

    def encode(units):
        for call in _calls(units):
            yield from [e.ids for e in tokenizer.encode_batch_fast(call, add_special_tokens=False)]

    return Side(encode, *_flat(tokens))


def piece_side(path: str) -> Side:
    """A SentencePiece model that sets a space before each text; encodes texts that start with that space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # No piece goes on after a space, or over a newline: stretches that start there stand alone.
    if any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces):
        raise ValueError("pieces reach over spaces or newlines: texts cannot be encoded by stretches")
    tokens = [
        bytes([int(_BYTE.fullmatch(p)[1], 16)]) if model.is_byte(i) else p.replace(_SPACE, " ").encode()
        for i, p in enumerate(pieces)
    ]
    # What the model writes for a newline, after its space; a stretch without that space is encoded after both.
    newline = model.encode("\n")
    # The model sets no space before an empty text.
    space = [model.piece_to_id(_SPACE)]

    def encode(units):
        for call in _calls(units):
            found = model.encode([u[1:] if u.startswith(" ") else "\n" + u for u in call], num_threads=1)
            for unit, ids in zip(call, found):
                yield space if unit == " " else ids if unit.startswith(" ") else ids[len(newline) :]

    return Side(encode, *_flat(tokens))


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray, lane: int = LANE):
    """Places of linked tokens of A and of B, in order; ``docs`` are where each document's tokens end.

    Byte ends are running sums over all documents, so a document's last tokens end together.
    """
    a, stop = _lanes(ends_a, ends_b, docs_a, docs_b, lane)
    b = np.concatenate([[0], np.searchsorted(ends_b, ends_a[stop[:-1] - 1]) + 1]) if len(stop) else stop
    links_a, links_b = [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        links_a.append(a[cut])
        links_b.append(b[cut])
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
        open_ = a < stop
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Every token is linked once at most and both orders are the byte order.
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


def _lanes(ends_a, ends_b, docs_a, docs_b, lane):
    """First tokens of A of all lanes, and where their tokens end: documents, the long ones split at shared ends."""
    first = np.concatenate([[0], docs_a[:-1]]) if len(docs_a) else docs_a
    kept = docs_a > first
    stops = docs_a[kept]
    starts = first[kept]
    inner = []
    for start, stop in zip(starts.tolist(), stops.tolist()):
        at = start + lane
        while at < stop:
            # The next shared end from here on; the document's own end is one.
            width = 64
            while True:
                window = ends_a[at : min(at + width, stop)]
                place = np.searchsorted(ends_b, window)
                shared = np.flatnonzero(ends_b[place] == window)
                if len(shared) or at + width >= stop:
                    break
                width *= 4
            at += int(shared[0]) + 1
            if at < stop:
                inner.append(at)
            at += lane
    stops = np.sort(np.concatenate([stops, np.array(inner, np.int64)])).astype(np.int64)
    return np.concatenate([[0], stops[:-1]]).astype(np.int64) if len(stops) else stops, stops


class Pair:
    """Two tokenizers on one worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_side(path_a), piece_side(path_b)
        # One store of stretches for both: ids of B are kept as their complements, which are negative.
        self._units = UnitEncoder(self._both, lambda text: [text], CACHE_UNITS)
        # Strings of group lists: an id and what stands after it, at id for a comma, then for a bar or semicolon.
        self._shown = [
            f"{i}{mark}"
            for side, marks in ((self.a, ",|"), (self.b, ",;"))
            for mark in marks
            for i in range(len(side.ends) - 1)
        ]

    def _both(self, units: Sequence[str]) -> Iterator[list[int]]:
        for a, b in zip(self.a.encode(units), self.b.encode(units)):
            yield [*a, *(~i for i in b)]

    def align(self, texts: Sequence[str | None]) -> list[tuple]:
        """Per text its ids of A, ids of B, places of linked tokens of A, and of B."""
        spaced = [f" {t}" if t else "" for t in texts]
        mixed, ends = self._units(spaced)
        of_b = mixed < 0
        ids_a, ids_b = mixed[~of_b], ~mixed[of_b]
        docs_b = np.concatenate([[0], np.cumsum(of_b)])[ends]
        docs_a = ends - docs_b
        ids_a, docs_a, ids_b, docs_b = self._same(spaced, ids_a, docs_a, ids_b, docs_b)
        ends_a, ends_b = np.cumsum(self.a.lengths(ids_a)), np.cumsum(self.b.lengths(ids_b))
        links_a, links_b = aligned(ends_a, ends_b, docs_a, docs_b)
        cuts = np.searchsorted(links_a, docs_a)
        out, at, was_a, was_b = [], 0, 0, 0
        for stop_a, stop_b, cut in zip(docs_a.tolist(), docs_b.tolist(), cuts.tolist()):
            out.append((ids_a[was_a:stop_a], ids_b[was_b:stop_b], links_a[at:cut] - was_a, links_b[at:cut] - was_b))
            at, was_a, was_b = cut, stop_a, stop_b
        return out

    def _same(self, spaced, ids_a, docs_a, ids_b, docs_b):
        """The same without the tokens of texts that the tokens' bytes do not give back."""
        raw = "".join(spaced).encode()
        joined_a, joined_b = self.a.bytes_of(ids_a), self.b.bytes_of(ids_b)
        if joined_a.tobytes() == raw and joined_b.tobytes() == raw:
            return ids_a, docs_a, ids_b, docs_b
        out = [], [], [], []
        was_a = was_b = 0
        for text, stop_a, stop_b in zip(spaced, docs_a.tolist(), docs_b.tolist()):
            own_a, own_b = ids_a[was_a:stop_a], ids_b[was_b:stop_b]
            was_a, was_b = stop_a, stop_b
            want = text.encode()
            if self.a.bytes_of(own_a).tobytes() != want or self.b.bytes_of(own_b).tobytes() != want:
                own_a = own_b = ids_a[:0]
            for kept, x in zip(out, (own_a, len(own_a), own_b, len(own_b))):
                kept.append(x)
        return np.concatenate(out[0]), np.cumsum(out[1]), np.concatenate(out[2]), np.cumsum(out[3])

    def listed(self, ids_a, ids_b, links_a, links_b) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.a.ends) - 1, len(self.b.ends) - 1
        group_a = np.searchsorted(links_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(links_b, np.arange(len(ids_b)))
        shown = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b = np.concatenate([[0], links_b + 1])
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[links_a] = n_a
        last_b[links_b] = n_b
        shown[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + last_a
        shown[np.arange(len(ids_b)) + links_a[group_b] + 1] = ids_b + last_b + 2 * n_a
        return "".join(map(self._shown.__getitem__, shown.tolist()))[:-1]


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id") -> DataFrame:
    """Per row: id, ids_a, ids_b, and ``links``, structs (place_a, place_b) of tokens that end together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                found = pair.align(texts)
                links = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([row[c] for row in found]).astype(np.int32)) for c in (2, 3)], ["place_a", "place_b"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)), _lists([r[0] for r in found]), _lists([r[1] for r in found]),
                        pa.ListArray.from_arrays(_offsets([r[2] for r in found]), links),
                    ],
                    [id_column, "ids_a", "ids_b", "links"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(
        run, f"`{id_column}` {kind}, ids_a array<int>, ids_b array<int>, links array<struct<place_a: int, place_b: int>>"
    )


def _offsets(parts: Sequence[np.ndarray]) -> pa.Array:
    return pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32))


def _lists(parts: Sequence[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(_offsets(parts), pa.array(np.concatenate(parts).astype(np.int32)))


LINKED_SCHEMA = (
    "row string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links array<struct<a: int, b: int>>"
)


def linked_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: a key, its numbers, the digest of its groups, and the ids that it links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, number = _pair(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                found = pair.align(texts)
                numbers = [pa.array([len(row[c]) for row in found], pa.int64()) for c in (0, 1, 2, 2)]
                digests = [hashlib.sha256(pair.listed(*row).encode()).hexdigest() if len(row[0]) else "" for row in found]
                ends = [
                    pa.array(np.concatenate([row[c][row[c + 2]] for row in found]).astype(np.int32)) for c in (0, 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{part}-{number + n}" for n in range(len(texts))]),
                        batch.column(0).slice(first, len(texts)), *numbers, pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(
                            _offsets([r[2] for r in found]), pa.StructArray.from_arrays(ends, ["a", "b"])
                        ),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
                )
                number += len(texts)

    return docs.select("doc_id", "text").mapInArrow(run, LINKED_SCHEMA)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links of the corpus hold each pair, and whether that is the most of its B token."""
    counted = linked.select(F.explode("links").alias("link")).groupBy("link.a", "link.b").agg(F.count(F.lit(1)).alias("n"))
    # A row per pair that the vocabularies allow, however large the corpus.
    counted = stored(counted)
    highest = counted.groupBy("b").agg(F.max("n").alias("highest"))
    return counted.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its numbers of tokens, groups and links, how its links count in the corpus, and its groups' digest."""
    linked = stored(linked_rows(docs, path_a, path_b))
    counts = stored(pair_counts(linked))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    # At most one row per byte of the two vocabularies: small whatever the corpus.
    met = (
        linked.select("row", F.explode("links").alias("link"))
        .select("row", "link.*")
        .join(F.broadcast(counts), ["a", "b"])
        .groupBy("row")
        .agg(F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))
    )
    none = F.lit(0).cast("long")
    return linked.select("row", *kept).join(met, "row", "left").select(
        *kept, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum")
    )
