"""Byte-level BPE from a rank file, as recursive DuckDB queries inside each partition.

Encoding: the stretches of a slice of texts that are new to the worker are cut by the pattern;
each distinct word becomes rows (word, position, token), one per byte.  A recursive query joins
adjacent rows with the merge table and contracts, per word, the leftmost pair of minimum rank,
until no pair of the word is in the table.  All pairs of that rank in a word are contracted in
one step where the new token cannot take part in a merge of lower rank, because then one at a
time gives the same.  Decoding: ids join the vocabulary and bytes are aggregated by position.

A query works on a bounded number of rows times steps; words that need more go on from where
they are.  Words of more than ``LONG`` bytes are contracted piece by piece and joined pairwise:
around each joint the last tokens of one part and the first of the next are contracted together,
and stand if they begin and end with the tokens that are there already.  A row of tokens is the
encoding of its bytes if every two neighbours are the encoding of theirs, so that is exact; a
joint that does not agree takes in twice as many tokens.  So long words and long texts need no
more memory, but for words that agree nowhere: those widen DuckDB's limit in proportion.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows are rows
of their own; only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pretokens import UnitEncoder, id_lists, slices

# Words up to so many bytes keep their tokens in one list; longer ones in one row per token.
SHORT = 48
# Words of more bytes are cut into pieces of ``PIECE`` bytes, joints begin with ``REACH`` tokens a side.
LONG = 4096
PIECE = 32
REACH = 6
# Workers keep what they hold for the next task, beside whatever that needs: all of it stays small.
CACHE_UNITS = 300_000
SLICE_CHARS = 1_000_000
# Rows a recursive query may produce, and rows one decoding query reads.
QUERY_ROWS = 200_000
DECODE_ROWS = 100_000
# DuckDB's memory, and bytes for each row that a contraction starts with.
MEMORY_MB = 200
WIDE_ROW = 1024
# Fixed value: what the rank files' pattern calls white space.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"

# Per word, the lowest (rank, place) of its token pairs is contracted; words without one drop out.
_CONTRACT_SHORT = """
WITH RECURSIVE merging(step, word, tokens) AS (
  SELECT 0, word, tokens FROM start
  UNION ALL
  SELECT any_value(step) + 1, word,
    any_value(tokens)[:(min(rank_place) & 4294967295) - 1] || [(min(rank_place) >> 32)::INTEGER]
      || any_value(tokens)[(min(rank_place) & 4294967295) + 2:]
  FROM (
    SELECT step, word, tokens, m.merged::BIGINT * 4294967296 + place AS rank_place
    FROM (
      SELECT step, word, tokens, unnest(tokens[:-2]) AS token, unnest(tokens[2:]) AS following, unnest(range(1, len(tokens))) AS place
      FROM merging
    ) p JOIN merges m ON m.first = p.token AND m.second = p.following
  )
  GROUP BY word
)
SELECT word, tokens FROM merging QUALIFY step = max(step) OVER (PARTITION BY word)
"""

_CONTRACT = """
WITH RECURSIVE merging(step, word, pos, token) AS (
  SELECT 0, word, pos, token FROM start
  UNION ALL
  SELECT step + 1, word, pos, CASE WHEN taken THEN merged ELSE token END
  FROM (
    SELECT *, coalesce(lag(taken) OVER (PARTITION BY word ORDER BY pos), false) AS eaten
    FROM (
      SELECT *, hit AND CASE WHEN safe
          THEN row_number() OVER (PARTITION BY word, hit, place - nth ORDER BY pos) % 2 = 1
          ELSE nth = 1 END AS taken
      FROM (
        SELECT *, coalesce(merged = best, false) AS hit,
          sum(CASE WHEN merged = best THEN 1 ELSE 0 END) OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING) AS nth
        FROM (
          SELECT p.*, m.merged, m.safe, min(m.merged) OVER (PARTITION BY word) AS best
          FROM (
            SELECT step, word, pos, token, row_number() OVER w AS place, lead(token) OVER w AS following
            FROM merging WHERE step < $steps WINDOW w AS (PARTITION BY word ORDER BY pos)
          ) p LEFT JOIN merges m ON m.first = p.token AND m.second = p.following
        ) WHERE best IS NOT NULL
      )
    )
  ) WHERE NOT eaten
)
SELECT word, pos, token, step FROM merging QUALIFY step = max(step) OVER (PARTITION BY word)
ORDER BY word, pos
"""

_DECODE = """
SELECT text, string_agg(hex, '' ORDER BY pos) AS hex FROM ids JOIN vocabulary USING (token) GROUP BY text ORDER BY text
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens that joins to a token; ``safe`` if no lower merge can follow from it."""
    first, second, merged = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                first.append(a)
                second.append(b)
                merged.append(rank)
    unsafe = {part for a, b, m in zip(first, second, merged) for part in (a, b) if m < part}
    return pa.table(
        {
            "first": pa.array(first, pa.int32()), "second": pa.array(second, pa.int32()),
            "merged": pa.array(merged, pa.int32()), "safe": pa.array([m not in unsafe for m in merged]),
        }
    )


class BytePairs:
    """One worker's DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, path: str, pattern: str, query_rows: int = QUERY_ROWS):
        import duckdb
        import regex

        self._ranks, self._rows = read_ranks(path), query_rows
        self._pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
        self._bytes = {rank: token for token, rank in self._ranks.items()}
        self._byte = np.array([self._ranks[bytes([b])] for b in range(256)], np.int32)
        self._db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{MEMORY_MB}MB", "temp_directory": ""})
        merges = merge_table(self._ranks)  # noqa: F841  DuckDB reads it by name
        self._db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        vocabulary = pa.table(  # noqa: F841
            {"token": pa.array(self._ranks.values(), pa.int32()), "hex": [t.hex() for t in self._ranks]}
        )
        self._db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")

    def cut(self, text: str) -> list[str]:
        return self._pattern.findall(text)

    def encode(self, units: Sequence[str]) -> list[list[int]]:
        """Ids of every unit: its words' ids one after the other."""
        words: dict[bytes, int] = {}
        made = []
        for unit in units:
            made.append([words.setdefault(w.encode(), len(words)) for w in self._pattern.findall(unit)])
        ids = self._encode_words(list(words))
        return [[i for w in parts for i in ids[w]] for parts in made]

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        found = [[self._ranks[w]] if w in self._ranks else None for w in words]
        for number, word in enumerate(words):
            if found[number] is None and len(word) > LONG:
                found[number] = self._join_pieces(word)
        self._contract(words, found)
        return found

    def _contract(self, words: list[bytes], found: list) -> None:
        """Ids of every word that has none yet."""
        for merge, chosen in ((self._merge_short, True), (self._merge, False)):
            batch, held = [], 0
            for number, word in enumerate(words):
                if found[number] is None and (len(word) <= SHORT) == chosen:
                    batch.append(number)
                    held += len(word)
                    if held * 4 >= self._rows:
                        merge(batch, words, found)
                        batch, held = [], 0
            merge(batch, words, found)

    def _contract_once(self, words: list[bytes]) -> list[list[int]]:
        different = list(dict.fromkeys(words))
        found: list = [None] * len(different)
        self._contract(different, found)
        ids = dict(zip(different, found))
        return [ids[w] for w in words]

    def _join_pieces(self, word: bytes) -> list[int]:
        pieces = [word[a : a + PIECE] for a in range(0, len(word), PIECE)]
        parts = self._contract_once(pieces)
        while len(parts) > 1:
            joints = list(zip(parts[::2], parts[1::2]))
            joined: list = [None] * len(joints)
            reach = REACH
            while None in joined:
                todo = [j for j, done in enumerate(joined) if done is None]
                around = [joints[j][0][-reach:] + joints[j][1][:reach] for j in todo]
                made = self._contract_once([b"".join(map(self._bytes.__getitem__, ids)) for ids in around])
                for j, ids in zip(todo, made):
                    a, b = joints[j]
                    if (len(a) <= reach or ids[0] == a[-reach]) and (len(b) <= reach or ids[-1] == b[reach - 1]):
                        joined[j] = a[:-reach] + ids + b[reach:]
                reach *= 2
            parts = joined + parts[2 * len(joints) :]
        return parts[0]

    def _merge_short(self, batch: list[int], words: list[bytes], found: list) -> None:
        if not batch:
            return
        ends = np.cumsum([len(words[n]) for n in batch])
        tokens = self._byte[np.frombuffer(b"".join(words[n] for n in batch), np.uint8)]
        start = pa.table({"word": pa.array(batch, pa.int32()), "tokens": id_lists(tokens, ends)})
        self._db.register("start", start)
        for number, ids in self._db.execute(_CONTRACT_SHORT).fetchall():
            found[number] = ids
        self._db.unregister("start")

    def _merge(self, batch: list[int], words: list[bytes], found: list) -> None:
        if not batch:
            return
        lengths = np.array([len(words[n]) for n in batch])
        self._db.execute(f"SET memory_limit = '{max(MEMORY_MB, int(lengths.sum()) * WIDE_ROW // 2**20)}MB'")
        word = np.repeat(np.array(batch, np.int32), lengths)
        pos = np.arange(len(word), dtype=np.int64)
        token = self._byte[np.frombuffer(b"".join(words[n] for n in batch), np.uint8)]
        while len(word):
            steps = max(1, self._rows // len(word))
            start = pa.table({"word": word, "pos": pos, "token": token})
            self._db.register("start", start)
            out = self._db.execute(_CONTRACT, {"steps": steps}).fetchnumpy()
            self._db.unregister("start")
            word, pos, token = (np.asarray(out[c]) for c in ("word", "pos", "token"))
            open_ = np.asarray(out["step"]) == steps
            done = ~open_
            if done.any():
                numbers, first = np.unique(word[done], return_index=True)
                for number, ids in zip(numbers, np.split(token[done], first[1:])):
                    found[number] = ids.tolist()
            word, pos, token = word[open_], pos[open_], token[open_]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of every text, given all ids and where each text's ids end."""
        starts = np.concatenate([[0], ends[:-1]])
        texts = [b""] * len(ends)
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + DECODE_ROWS, "right")))
            to = min(to, len(ends))
            for a in range(int(starts[at]), int(ends[to - 1]), DECODE_ROWS):
                b = min(a + DECODE_ROWS, int(ends[to - 1]))
                pos = np.arange(a, b)
                table = pa.table({"text": np.searchsorted(ends, pos, "right"), "pos": pos, "token": ids[a:b]})
                self._db.register("ids", table)
                out = self._db.execute(_DECODE).fetchnumpy()
                self._db.unregister("ids")
                for text, hexed in zip(out["text"], out["hex"]):
                    texts[text] += bytes.fromhex(hexed)
            at = to
        return texts


@lru_cache(maxsize=2)
def _pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> UnitEncoder:
    pairs = _pairs(path, pattern)
    return UnitEncoder(pairs.encode, pairs.cut, CACHE_UNITS)


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, ids) for every row's ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                ids, ends = encoder(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), id_lists(ids, ends)], [id_column, "ids"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def decode(tokens: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, decoded) for every row's ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _pairs(ranks, pattern)
        for batch in batches:
            lists = batch.column(1)
            offsets, ids = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            for a in range(0, len(lists), 256):
                cuts = offsets[a : a + 257]
                texts = pairs.decode(ids[cuts[0] : cuts[-1]], cuts[1:] - cuts[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(texts)), pa.array(texts, pa.binary())], [id_column, "decoded"]
                )

    kind = tokens.schema[id_column].dataType.simpleString()
    return tokens.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, decoded binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids count as little-endian 32-bit integers.

    Encodes and decodes in one pass, so one worker holds one cache and one connection.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pairs = _encoder(ranks, pattern), _pairs(ranks, pattern)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_CHARS):
                ids, ends = encoder(texts)
                starts = np.concatenate([[0], ends[:-1]])
                data = memoryview(ids.astype("<u4")).cast("B")
                sums = [hashlib.sha256(data[4 * a : 4 * b]).hexdigest() for a, b in zip(starts, ends)]
                back = [hashlib.sha256(t).hexdigest() for t in pairs.decode(ids, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(ends - starts), pa.array(sums), pa.array(back)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
