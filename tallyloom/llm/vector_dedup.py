"""Near-duplicate vectors: cosine >= 0.98 among vectors of equal label.

1. Vectors are scaled to length one; equal vectors of a label fall into one class.
2. Every label's classes are dealt into shards by hash; each shard becomes one navigable
   small-world graph, stored as a row of arrays, and is audited as it is built.  An audit takes
   a hashed sample of the shard and asks for each vector itself and for the vector turned by
   some degrees, so that every turned one has a link however rare links are.  The beam doubles
   until ``recall`` of the links that a full scan of the sample finds, and of the queries' whole
   link sets, are found.
3. Every vector queries every shard of its label with that shard's beam; single queries whose
   beam is full of links widen it.  A query whose beam would reach an eighth of the shard scans
   the shard instead, so nothing is cut off.  Shards without links cost a walk per query.
4. Candidates are verified in double precision.  Two shards ask each other in one task, and a
   link found from either end counts once at both.  Each task returns link counts and the root
   of the links it saw per class, never pairs; roots are united to components.

Defined cases: rows with a null label, and vectors that are null, empty, zero or hold null or
non-finite components link with nothing; vectors of different length never link; equal rows are
copies and link with each other; a null id takes no part; an empty table gives an empty table;
only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import components
from .small_world import SmallWorld

THRESHOLD = 0.98
# Vectors of a shard; its graph is about 600 bytes a vector at 64 dimensions.
SHARD = 8192
BEAM = 16
# Vectors of a shard that its audit turns and asks for, and how many it asks for at once.
AUDIT = 1000
_ASKED = 128
RECALL = 0.999
# Candidates are taken this much below the threshold: graphs hold single precision.
_SLACK = 1e-4

_UNIT_SCHEMA = "vec_id long, label string, dims int, node string, unit array<double>"


def units(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dims, node, unit); ``unit`` is null where a vector takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, scaled, dims = [], [], []
            lists = batch.column(2)
            for row in range(len(batch)):
                node = unit = None
                size = 0
                if lists[row].is_valid and batch.column(1)[row].is_valid and batch.column(0)[row].is_valid:
                    v = lists[row].values.to_numpy(zero_copy_only=False).astype(np.float64)
                    scale = np.abs(v).max(initial=0)
                    if np.isfinite(v).all() and scale > 0:
                        v = v / scale
                        unit, size = v / np.sqrt(v @ v), len(v)
                        node = hashlib.md5(f"{batch.column(1)[row]}:".encode() + unit.tobytes()).hexdigest()
                nodes.append(node)
                scaled.append(unit)
                dims.append(size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(nodes, pa.string()),
                    pa.array(scaled, pa.list_(pa.float64())),
                ],
                ["vec_id", "label", "dims", "node", "unit"],
            )

    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return plain.mapInArrow(run, _UNIT_SCHEMA)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


_GRAPH_SCHEMA = (
    "label string, dims int, shard int, members array<string>, graph binary, beam int, audited long, found long"
)


def _build(group: pd.DataFrame, threshold: float = THRESHOLD, beam: int = BEAM, recall: float = RECALL, audit: int = AUDIT) -> pd.DataFrame:
    group = group.sort_values("node", kind="stable")
    x = _matrix(group["unit"])
    graph = SmallWorld(x)
    beam, audited, found = audited_beam(graph, x, threshold, beam, recall, audit)
    head = [graph.entry, len(graph.levels), *[level.shape[1] for level in graph.levels]]
    blob = np.array(head, np.int32).tobytes() + b"".join(level.tobytes() for level in graph.levels) + x.tobytes()
    first = group.iloc[0]
    return pd.DataFrame(
        {
            "label": [first["label"]], "dims": [first["dims"]], "shard": [first["shard"]],
            "members": [group["node"].tolist()], "graph": [blob], "beam": [beam], "audited": [audited], "found": [found],
        }
    )


def _load(members: int, dims: int, blob: bytes) -> tuple[SmallWorld, np.ndarray]:
    entry, count = np.frombuffer(blob, np.int32, 2)
    widths = np.frombuffer(blob, np.int32, count, 8)
    at = 8 + 4 * count
    graph = SmallWorld.__new__(SmallWorld)
    graph.entry, graph.levels = int(entry), []
    for width in widths:
        graph.levels.append(np.frombuffer(blob, np.int32, members * width, at).reshape(members, width))
        at += 4 * members * width
    x = np.frombuffer(blob, np.float64, members * dims, at).reshape(members, dims)
    graph.x = x.astype(np.float32)
    return graph, x


def scan(x: np.ndarray, queries: np.ndarray, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) of all links of the queries at ``rows``, by comparing them with every member."""
    found = [np.nonzero(queries[rows[a : a + 512]] @ x.T >= threshold) for a in range(0, len(rows), 512)]
    q = [rows[a * 512 + hit[0]] for a, hit in enumerate(found)]
    return np.concatenate([np.zeros(0, int), *q]), np.concatenate([np.zeros(0, int), *[hit[1] for hit in found]])


def find_links(
    graph: SmallWorld, x: np.ndarray, queries: np.ndarray, threshold: float, beam: int, own: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) of the links found by walking the graph with a beam.

    ``own``: queries are the members themselves, and none links with itself.
    """

    def look(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width * 8 >= len(x):
            return scan(x, queries, rows, threshold)
        ids, sims = graph.search(queries[rows], width)
        # A beam whose every entry is near enough may have cut links off.
        full = (sims >= threshold - _SLACK).all(axis=1)
        near = (sims >= threshold - _SLACK) & ~full[:, None]
        q, m = rows[np.nonzero(near)[0]], ids[near]
        sure = np.einsum("nd,nd->n", queries[q], x[m]) >= threshold
        wider = look(rows[full], width * 8) if full.any() else (np.zeros(0, int), np.zeros(0, int))
        return np.concatenate([q[sure], wider[0]]), np.concatenate([m[sure], wider[1]])

    q, m = look(np.arange(len(queries)), beam)
    return (q[q != m], m[q != m]) if own else (q, m)


def probes(x: np.ndarray, threshold: float, audit: int) -> np.ndarray:
    """Vectors drawn by hash, and the same ones turned until their cosine is a quarter above the threshold."""
    random = np.random.default_rng(len(x))
    # Names are digests, so any order drawn without looking at vectors gives a random sample.
    drawn = x[random.permutation(len(x))[:audit]]
    aside = random.normal(size=drawn.shape)
    aside -= np.einsum("nd,nd->n", aside, drawn)[:, None] * drawn
    length = np.sqrt(np.einsum("nd,nd->n", aside, aside))[:, None]
    cosine = threshold + (1 - threshold) / 4
    # In one dimension there is no way aside, and the vector stays.
    turned = np.where(length > 1e-9, cosine * drawn + np.sqrt(1 - cosine * cosine) * aside / np.maximum(length, 1e-9), drawn)
    return np.concatenate([drawn, turned])


def audited_beam(graph: SmallWorld, x: np.ndarray, threshold: float, beam: int, recall: float, audit: int) -> tuple[int, int, int]:
    """The beam that finds enough, how many links the audit's scan found, and how many that beam found."""
    queries = probes(x, threshold, audit)
    blocks = [queries[a : a + _ASKED] for a in range(0, len(queries), _ASKED)]
    # What a walk finds is verified, so counts per query tell how much it misses.
    counted = lambda links: [np.bincount(links(b)[0], minlength=len(b)) for b in blocks]
    truth = np.concatenate(counted(lambda b: scan(x, b, np.arange(len(b)), threshold)))
    while True:
        hit = np.concatenate(counted(lambda b: find_links(graph, x, b, threshold, beam)))
        linked = truth > 0
        enough = hit.sum() >= recall * truth.sum() and (hit == truth)[linked].sum() >= recall * linked.sum()
        if enough or beam * 8 >= len(x):
            return beam, int(truth.sum()), int(hit.sum())
        beam *= 2


_LINK_SCHEMA = "node string, links long, root string"


def _query(threshold: float):
    def run(shards: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"node": pd.Series([], dtype=str), "links": pd.Series([], dtype="int64"), "root": pd.Series([], dtype=str)})
        first = shards.iloc[0]
        if first["low"] != first["high"] and len(shards) < 2:
            return nothing
        # One shard and itself, or two shards that ask each other.
        shards = shards.sort_values("shard", kind="stable")
        sides = [_load(len(m), int(d), g) for m, d, g in zip(shards["members"], shards["dims"], shards["graph"])]
        (graph, x), (other_graph, other_x) = sides[0], sides[-1]
        own = len(sides) == 1
        beams = shards["beam"].tolist()
        ask = lambda g, v, queries, beam: find_links(g, v, queries, threshold, beam, own)
        a, b = ask(other_graph, other_x, x, beams[-1])
        if not own:
            back_b, back_a = ask(graph, x, other_x, beams[0])
            a, b = np.concatenate([a, back_a]), np.concatenate([b, back_b]) + len(x)
        if not len(a):
            return nothing
        names = np.concatenate([np.asarray(m, object) for m in shards["members"]])
        copies = np.concatenate([np.asarray(c, np.int64) for c in shards["copies"]])
        # A link found from one end, or from both, counts once at each end.
        pairs = np.unique(np.minimum(a, b) * len(names) + np.maximum(a, b))
        a, b = pairs // len(names), pairs % len(names)
        links = np.bincount(a, copies[b], len(names)) + np.bincount(b, copies[a], len(names))
        used = np.flatnonzero(links)
        used = used[np.argsort(names[used], kind="stable")]
        place = np.zeros(len(names), int)
        place[used] = np.arange(len(used))
        a, b = place[a], place[b]
        # Smallest name over the links seen here, repeated until it settles.
        root = np.arange(len(used))
        while True:
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"node": names[used], "links": links[used].astype(np.int64), "root": names[used][root]})

    return run


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, beam: int = BEAM, recall: float = RECALL, audit: int = AUDIT,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable), ``kept``."""
    all_units = stored(units(vectors))
    classes = all_units.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("label").alias("label"), F.first("dims").alias("dims"), F.first("unit").alias("unit"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
    )
    classes = stored(classes)
    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = stored(
        classes.join(sizes, ["label", "dims"]).withColumn("shard", F.pmod(F.xxhash64("node"), "shards").cast("int"))
    )
    graphs = stored(
        dealt.select("label", "dims", "shard", "node", "unit").groupBy("label", "dims", "shard").applyInPandas(
            lambda group: _build(group, threshold, beam, recall, audit), _GRAPH_SCHEMA
        )
    )
    counts = dealt.groupBy("label", "dims", "shard").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("node", "copies"))), lambda x: x["copies"]).alias("copies")
    )
    # Graphs hold their vectors, so a pair of shards needs nothing else.
    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    paired = graphs.join(counts, ["label", "dims", "shard"]).join(sizes, ["label", "dims"]).withColumn("other", other).select(
        "label", "dims", "shard", "members", "graph", "beam", "copies",
        F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"),
    )
    linked = stored(
        paired.groupBy("label", "dims", "low", "high").applyInPandas(_query(threshold), _LINK_SCHEMA)
    )
    roots = components(linked, "node", "root").select(F.col("node").alias("__node"), "root")
    sums = linked.groupBy("node").agg(F.sum("links").alias("links")).select(F.col("node").alias("__linked"), "links")
    per_class = stored(
        classes.select("node", "copies", "least")
        .join(sums, F.col("node") == F.col("__linked"), "left")
        .join(roots, F.col("node") == F.col("__node"), "left")
        .select("node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    names = stored(per_class.groupBy("root").agg(F.min("least").alias("component_id")))
    answer = stored(per_class.join(names, "root").select("node", "n_links", "component_id"))
    result = all_units.select("vec_id", "node").join(answer, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id").isNull() | (component == F.col("vec_id"))).alias("kept"),
    )
