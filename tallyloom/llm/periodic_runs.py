"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q and length >= 2 q that no neighbouring word
extends.  The dictionary names every stretch of 2^k words that occurs again in its text, k = 2, 3, ...;
a name of level k + 1 is the pair of names of its halves, so a stretch whose half is unique needs none.

Level k, with L = 2^k, proposes the periods up to 2 L.  Occurrences of one name at most L / 2
apart lie at equal distances (two periods of at most L / 2 make their divisor a period), so they
form arithmetic progressions, which lie more than L / 2 apart; three at most follow another within 2 L.
A progression proposes its difference, and two progressions propose the distances between their
members, themselves a progression.  A run of length n and period q has every pair of stretches q
apart named alike at the level with L <= n - q < 2 L, where q < 2 L; so the pairs of one period and
neighbouring places extend each other to exactly the run.  Runs of several levels are the same; a
stretch proposed with a multiple of its period too keeps the smallest one.

Work is O(n log n) names for n words, memory O(n), and the proposals of a level are O(n): nothing
is cut short in periodic texts.  ``planted`` makes the texts of the query more periodic by rule.

Defined cases: null, empty and white-space texts have no words and no run; repeated rows are rows
of their own; a null id plants nothing; of runs equal in length the first, then the one of smaller
period is the greatest; only the id and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pretokens import slices

# Shortest run; a run leaves at least half of it beside one period, which a stretch of 4 fits into.
MIN_LENGTH = 12
_FIRST_LEVEL = 2
SLICE_CHARS = 2_000_000


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8; bytes split at exactly the six ASCII white-space characters."""
    return (text or "").encode().split()


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Where the id's checksum ends in 0: words from some place on repeat the first of them."""
    if doc_id is None or not words:
        return words
    group, digit = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if digit:
        return words
    first = group % len(words)
    rest = len(words) - first
    period = 1 + rest // (3 + group % 8)
    cycle = words[first : first + period]
    return words[:first] + (cycle * (rest // period + 1))[:rest]


def _numbered(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words one after the other, and where each text ends."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    names = np.fromiter((number(w, len(known)) for words in texts for w in words), np.int64)
    return names, np.cumsum([len(words) for words in texts])


def runs(texts: Sequence[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Per text the rows (start, length, period) of its runs, by start, then period."""
    if min_length < 2 << _FIRST_LEVEL:
        raise ValueError("runs shorter than 8 words need stretches shorter than 4")
    names, ends = _numbered(texts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    at, level, found = np.arange(len(names)), 0, []
    while len(at):
        if level >= _FIRST_LEVEL:
            found.append(_merged(*_proposals(names, at, text_of, 1 << level), 1 << level, min_length))
        names, at = _longer(names, at, text_of, ends, 1 << level)
        level += 1
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # The same stretch comes from several levels, and with multiples of its period.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    cuts = np.searchsorted(start, ends)
    firsts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return [
        np.stack([start[a:b] - first, length[a:b], period[a:b]], axis=1)
        for a, b, first in zip(np.concatenate([[0], cuts[:-1]]), cuts, firsts)
    ]


def _longer(names, at, text_of, ends, size):
    """Names of stretches twice as long that occur again in their text, and their places by name and place."""
    at = np.sort(at)
    at = at[at + 2 * size <= ends[text_of[at]]]
    first, second = names[at], names[at + size]
    both = second >= 0
    at, pair = at[both], first[both] * (len(names) + 1) + second[both]
    order = np.argsort(pair, kind="stable")
    at, pair = at[order], pair[order]
    new = np.ones(len(at), bool)
    new[1:] = pair[1:] != pair[:-1]
    with_next = np.zeros(len(at), bool)
    with_next[:-1] = ~new[1:] & (text_of[at[1:]] == text_of[at[:-1]])
    again = with_next.copy()
    again[1:] |= with_next[:-1]
    longer = np.full(len(names), -1, np.int64)
    longer[at[again]] = np.cumsum(new)[again]
    return longer, at[again]


def _proposals(names, at, text_of, size):
    """(period, first place, last place) such that stretches from any place in between recur a period later."""
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    name, text = names[at], text_of[at]
    gap = np.diff(at)
    same = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
    close = same & (2 * gap <= size)
    heads = np.flatnonzero(np.concatenate([[True], ~close]))
    tails = np.concatenate([heads[1:], [len(at)]]) - 1
    first, last = at[heads], at[tails]
    step = np.where(tails > heads, (last - first) // np.maximum(tails - heads, 1), 0)
    many = tails > heads
    out = [(step[many], first[many], last[many] - step[many])]
    for ahead in (1, 2, 3):
        a, b = np.arange(len(heads) - ahead), np.arange(ahead, len(heads))
        kept = (name[heads[a]] == name[heads[b]]) & (text[heads[a]] == text[heads[b]]) & (first[b] - last[a] <= 2 * size)
        a, b = a[kept], b[kept]
        least = first[b] - last[a]
        both_step = np.maximum(step[a], step[b])
        members = (tails - heads)[a] + (tails - heads)[b]
        within = np.where(both_step > 0, (2 * size - least) // np.maximum(both_step, 1), 0)
        times = np.minimum(members, within) + 1
        a, b, least, both_step = (np.repeat(x, times) for x in (a, b, least, both_step))
        nth = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        period = least + nth * both_step
        out.append((period, np.maximum(first[a], first[b] - period), np.minimum(last[a], last[b] - period)))
    return tuple(np.concatenate(columns) for columns in zip(*out))


def _merged(period, low, high, size, min_length):
    """Rows start, length, period: places of one period that touch are one run."""
    order = np.lexsort((low, period))
    period, low, high = period[order], low[order], high[order]
    if not len(period):
        return np.zeros((3, 0), np.int64)
    # The furthest place so far within a period: periods are spread so far apart that none reaches into the next.
    spread = np.cumsum(np.diff(period, prepend=period[0]) != 0) * (int(high.max()) + 2)
    reach = np.maximum.accumulate(spread + high)
    new = np.ones(len(period), bool)
    new[1:] = spread[1:] + low[1:] > reach[:-1] + 1
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(period)]]) - 1
    start, period = low[heads], period[heads]
    length = reach[tails] - spread[tails] + size + period - start
    kept = length >= np.maximum(min_length, 2 * period)
    return np.stack([start[kept], length[kept], period[kept]])


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words left when every run keeps only its first period."""
    if not len(found):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(edges)[:-1] > 0
    return [w for w, gone in zip(words, dropped.tolist()) if not gone]


def find_runs(docs: DataFrame, id_column: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, runs, collapsed): each row's runs as structs (start, length, period), and its text without repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                words = [words_of(t) for t in texts]
                found = runs(words, min_length)
                rows = np.concatenate(found)
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"])
                kept = [b" ".join(collapsed(w, f)).decode() for w, f in zip(words, found)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(kept, pa.string()),
                    ],
                    [id_column, "runs", "collapsed"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(
        run, f"`{id_column}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


DIGEST_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def digests(docs: DataFrame) -> DataFrame:
    """The runs of every row's planted words: number, greatest run, and digests of all runs and of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                ids = batch.column(0).slice(first, len(texts))
                words = [planted(words_of(t), i) for t, i in zip(texts, ids.to_pylist())]
                rows = []
                for kept, found in zip(words, runs(words)):
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found.tolist())
                    rest = hashlib.sha256(b" ".join(collapsed(kept, found))).hexdigest()
                    best = min(found.tolist(), key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
                    exponent = 1000 * best[1] // best[2] if len(found) else None
                    rows.append((len(found), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), rest))
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST_SCHEMA)
