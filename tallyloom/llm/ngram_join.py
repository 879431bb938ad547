"""Near-duplicate texts: all pairs whose sets of five-word n-grams have Jaccard similarity >= 0.8.

1. Equal texts fall into one class; only classes are compared.
2. MinHash signatures are cut into bands.  Band and row counts follow from the target recall at
   the threshold.  Band hashes are shuffled; classes that share one are candidates.
3. Candidates are not listed as pairs.  Classes connected by shared band hashes form groups;
   groups are cut into blocks by size of set, and each pair of blocks is one task that verifies
   its pairs on the full n-gram sets and returns, per class, a number of links and the root of
   its links inside that pair of blocks.  Rows grow with classes times blocks, never with pairs.
4. Link counts are summed, and roots are united to components.

A group has more pairs than those that share a band, so the join finds every link that banding
would, and more.

Words are ``[^\\x20\\x09-\\x0D]+``; a text with one to four words has its whole word sequence as
its only n-gram.  N-grams are compared by 64-bit hashes.

Defined cases: null texts and texts without words link with nothing; equal texts link with each
other; rows that repeat id and text are copies like any others; rows with a null id take no
part: they have null classes, no links, and are kept; an empty table gives an empty table; only
``doc_id`` and ``text`` are read, so other columns may have any name.  ``drop_near_duplicates``
works on rows in place of ids: of a component it keeps one row, that with the smallest id, then
the smallest digest of its text; null ids take part by their text and come after all others.
Rows without words all stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.ordinals import with_ordinal
from ..session import stored
from .common import WORD, columns_of, components

N = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
MAX_HASHES = 96
BLOCK = 256
# Columns of one intersection step: a block pair times so many n-grams is held as a matrix.
_STEP = 4096
# Null ids come after all others.
_LAST_ID = 2**63 - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, and so the fewest false candidates, that reach the recall."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        miss = 1 - threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss)))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def ngram_hashes(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(h))
    count = len(h) - width + 1
    out = np.full(count, np.uint64(len(words) if len(words) < n else n))
    for k in range(width):
        out = (out ^ h[k : k + count]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    a = random.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], random.integers(0, 2**63, count, np.uint64)[:, None]


def signature_bands(grams: np.ndarray, a: np.ndarray, b: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of a MinHash signature."""
    least = np.full(len(a), np.uint64(2**64 - 1))
    for at in range(0, len(grams), 2048):
        part = grams[None, at : at + 2048] * a
        part ^= b
        np.minimum(least, part.min(axis=1), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        out = (out ^ column) * _MIX
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, bands) of every text with words; ``bands`` is null for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _parameters(bands * rows)
        for batch in batches:
            lists = []
            for text in batch.column(2):
                grams = ngram_hashes(text.as_py(), n)
                lists.append(signature_bands(grams, a, b, bands, rows) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "text_key", "bands"]
            )

    keyed = docs.select("doc_id", F.md5("text").alias("text_key"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_key string, bands array<long>")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(new) - 1
    # N-grams that only one side, or only one set, has are in no intersection.
    on_left = np.zeros(number[-1] + 1, bool)
    on_right = np.zeros(number[-1] + 1, bool)
    on_left[number[owner < len(left)]] = True
    on_right[number[owner >= len(left)]] = True
    useful = (on_left & on_right)[number]
    number, owner = number[useful], owner[useful]
    counts = np.zeros((len(left), len(right)), np.int64)
    if not len(number):
        return counts
    number = np.cumsum(np.concatenate([[0], number[1:] != number[:-1]]))
    for first in range(0, int(number[-1]) + 1, _STEP):
        a, b = np.searchsorted(number, [first, first + _STEP])
        dense = np.zeros((len(left) + len(right), _STEP), np.float32)
        dense[owner[a:b], number[a:b] - first] = 1
        counts += (dense[: len(left)] @ dense[len(left) :].T).astype(np.int64)
    return counts


def link_matrix(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    shared = shared_counts(left, right)
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return shared >= threshold * (sizes - shared)


def roots_of(links: np.ndarray) -> np.ndarray:
    """Smallest index reachable over a symmetric link matrix."""
    root = np.arange(len(links))
    masked = links | np.eye(len(links), dtype=bool)
    while True:
        new = np.where(masked, root[None, :], len(links)).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable")
        a, b = group["block_a"].iloc[0], group["block_b"].iloc[0]
        sets = [np.asarray(x).view(np.uint64) for x in group["grams"]]
        weight = group["copies"].to_numpy()
        mine = group["block"].to_numpy() == a
        if a == b:
            links = link_matrix(sets, sets, threshold)
            np.fill_diagonal(links, False)
        else:
            i, j = np.flatnonzero(mine), np.flatnonzero(~mine)
            links = np.zeros((len(sets), len(sets)), bool)
            links[np.ix_(i, j)] = link_matrix([sets[k] for k in i], [sets[k] for k in j], threshold)
            links |= links.T
        names = group["node"].to_numpy()
        out = pd.DataFrame({"node": names, "links": links @ weight, "root": names[roots_of(links)]})
        return out[out["links"] > 0]

    return run


def near_duplicates(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_class`` (smallest id with the same text), ``n_links``
    (other documents within the threshold), ``class_id`` (smallest id connected by links), ``kept``.
    """
    return classified(docs, n, threshold, recall, block).drop("text_key")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each component of near duplicates, and the rows without words."""
    last = F.coalesce(F.col("doc_id"), F.lit(_LAST_ID))
    _, per_class = _per_class(docs.select(last.alias("doc_id"), "text"), **options)
    firsts = per_class.groupBy("__root").agg(F.min(F.struct("text_class", "text_key")).alias("f"))
    mark = lambda doc_id, key: F.md5(F.concat_ws(":", doc_id.cast("string"), key))
    kept = stored(firsts.select(mark(F.col("f.text_class"), F.col("f.text_key")).alias("__mark")))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # Copies of a row are cut to one in every task before they are shuffled for window and join.
    row = W.partitionBy("__mark").orderBy(F.col("doc_id").asc_nulls_last(), "__at")
    marked = docs.where(worded).withColumns({"__mark": mark(last, F.md5("text")), "__at": F.monotonically_increasing_id()})
    single = marked.withColumn("__row", F.row_number().over(row)).where("__row = 1")
    single = single.join(kept.hint("merge"), "__mark", "left_semi")
    return single.select(*columns_of(docs)).unionByName(docs.where(~worded))


def classified(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK
) -> DataFrame:
    """What ``near_duplicates`` returns, with the digest ``text_key`` of each row's text (null for null)."""
    signed, per_class = _per_class(docs, n, threshold, recall, block)
    names = stored(per_class.groupBy("__root").agg(F.min("text_class").alias("class_id")))
    answer = stored(per_class.join(names, "__root").drop("__root"))
    found = F.col("doc_id").isNotNull() & F.col("bands").isNotNull()
    result = signed.select("doc_id", "text_key", F.when(found, F.col("text_key")).alias("__key")).join(
        answer.withColumnRenamed("text_key", "__key"), "__key", "left"
    )
    own = lambda c: F.coalesce(c, F.col("doc_id"))
    found = F.col("doc_id").isNotNull()
    return result.select(
        "doc_id", "text_key",
        F.when(found, own("text_class")).alias("text_class"),
        F.when(found, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(found, own("class_id")).alias("class_id"),
        (~found | (own("class_id") == F.col("doc_id"))).alias("kept"),
    )


def _per_class(
    docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Signatures by row, and (text_key, text_class, n_links, __root) of every class of equal texts."""
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signatures(docs, n, bands, rows))
    named = signed.where(F.col("doc_id").isNotNull() & F.col("bands").isNotNull())
    # Equal texts have equal bands: any copy's will do.
    classes = stored(named.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("text_class"), F.first("bands").alias("bands")
    ))
    hashes = classes.select(F.col("text_key").alias("node"), F.posexplode("bands").alias("band", "hash"))
    buckets = stored(
        hashes.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"))
        .where("size > 1").select("band", "hash", "hub")
    )
    near = hashes.join(buckets, ["band", "hash"]).select("node", "hub")
    groups = components(near, "node", "hub")
    members = groups.join(classes, groups["node"] == classes["text_key"]).select("root", "node", "text_class", "copies")
    linked = _links_in_groups(docs, stored(members), n, threshold, block)
    united = components(linked, "node", "root").select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    sums = linked.groupBy("node").agg(F.sum("links").alias("__links"))
    per_class = (
        classes.select("text_key", "copies", "text_class")
        .join(sums, F.col("text_key") == F.col("node"), "left")
        .join(united, F.col("text_key") == F.col("__node"), "left")
        .select(
            "text_key", "text_class", (F.col("copies") - 1 + F.coalesce("__links", F.lit(0))).alias("n_links"),
            F.coalesce("__root", "text_key").alias("__root"),
        )
    )
    return signed, stored(per_class)


def _links_in_groups(docs: DataFrame, members: DataFrame, n: int, threshold: float, block: int) -> DataFrame:
    """(node, links, root) for every class and pair of blocks in which it has a link."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [ngram_hashes(t.as_py(), n).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in lists], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                ["node", "size", "grams"],
            )

    # One document of each class supplies its text.
    one = docs.select("doc_id", "text", F.md5("text").alias("text_key")).join(
        # Candidates grow with the corpus: the same plan at every size.
        members.select(F.col("text_class").alias("doc_id"), F.col("node").alias("text_key")).hint("merge"),
        ["doc_id", "text_key"], "left_semi",
    )
    sets = stored(one.select("text_key", "text").mapInArrow(grams, "node string, size long, grams array<long>"))
    sized = sets.select("node", "size").distinct().join(members, "node").select("root", "node", "copies", "size")
    placed = with_ordinal(sized, [F.col("size").asc(), F.col("node").asc()], ["root"], "place").withColumn(
        "block", F.floor((F.col("place") - 1) / block).cast("int")
    )
    placed = stored(placed)
    spans = stored(placed.groupBy("root", "block").agg(F.min("size").alias("least"), F.max("size").alias("most")))
    # Blocks are ordered by size: a later block can only link if its smallest set is near enough.
    a, b = spans.alias("a"), spans.alias("b")
    pairs = a.join(
        b,
        (F.col("a.root") == F.col("b.root")) & (F.col("a.block") <= F.col("b.block"))
        & (F.col("a.most") >= F.col("b.least") * F.lit(threshold)),
    ).select("a.root", F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    sides = pairs.select("root", "block_a", "block_b", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    placed_sets = placed.join(sets.dropDuplicates(["node"]), "node").select("root", "block", "node", "copies", "grams")
    work = placed_sets.join(sides, ["root", "block"])
    return stored(
        work.groupBy("root", "block_a", "block_b").applyInPandas(_verify(threshold), "node string, links long, root string")
    )
