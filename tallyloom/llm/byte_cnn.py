"""A byte-level convolutional network in numpy, and its use as a quality classifier in Spark.

Every byte has a learned vector; filters over five bytes give activations at every position.
Half-chunks of 128 bytes are max-pooled, neighbouring halves join to overlapping chunks of 256
bytes, and chunks cover the document from end to end.  The mean, the maximum and the minimum
over chunks of every filter are combined into one probability.

The network is fitted on a bounded sample: at most ``MAX_ROWS`` labelled rows of each class,
chosen by hash, each with a window of at most ``CROP`` characters at a hashed place.  Scoring
reads every byte of every text.

Defined cases: null and empty texts are scored as one blank chunk; a document with contradicting
or null labels is not learned from; without labels of both classes every score is the same, near
the share of label 1 (0.5 without labels); repeated rows get equal scores; columns beside ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

WIDTH = 5
VECTOR = 8
FILTERS = 24
HALF = 128
MAX_ROWS = 1500
CROP = 4096
EPOCHS = 10
BATCH = 32
RATE = 0.01
DECAY = 1e-4
GLIMPSES = 0.25
SEED = 11
# Bytes whose activations are held at once.
_BLOCK = 512 * HALF

Weights = dict[str, np.ndarray]


def new_weights(seed: int = SEED) -> Weights:
    random = np.random.default_rng(seed)
    return {
        "vectors": random.normal(0, 0.5, (256, VECTOR)),
        "filters": random.normal(0, 0.4, (WIDTH, VECTOR, FILTERS)),
        "shift": np.zeros(FILTERS),
        "mean": random.normal(0, 0.1, FILTERS),
        "max": random.normal(0, 0.1, FILTERS),
        "min": random.normal(0, 0.1, FILTERS),
        "bias": np.zeros(1),
    }


def padded(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, each filled up to whole half-chunks, and their halves."""
    halves = np.array([max(1, -(-len(t) // HALF)) for t in texts])
    data = b"".join(t.ljust(h * HALF, b"\0") for t, h in zip(texts, halves.tolist()))
    return np.frombuffer(data, np.uint8), halves


def _tables(weights: Weights) -> list[tuple[np.ndarray, int, bool]]:
    """Lookup tables (table, offset, of two bytes) that add up to the convolution."""
    single = np.einsum("bv,kvf->kbf", weights["vectors"], weights["filters"]).astype(np.float32)
    tables = [
        ((single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, -1), k, True) for k in range(0, WIDTH - 1, 2)
    ]
    return tables + ([(single[WIDTH - 1], WIDTH - 1, False)] if WIDTH % 2 else [])


def pool_halves(data: np.ndarray, halves: np.ndarray, tables, shift: np.ndarray, places: bool = False):
    """Largest activation per half-chunk and filter, never below 0, and optionally where it is.

    A filter reads on into the next half of its own document, and blanks after its end.
    """
    n = int(halves.sum())
    out = np.empty((n, len(shift)), np.float32)
    where = np.empty((n, len(shift)), np.int64) if places else None
    ends = np.cumsum(halves) * HALF
    for first in range(0, n, _BLOCK // HALF):
        a, b = first * HALF, min((first + _BLOCK // HALF) * HALF, len(data))
        part = np.zeros(b - a + WIDTH, np.uint8)
        have = min(len(data), b + WIDTH) - a
        part[:have] = data[a : a + have]
        pairs = part[:-1].astype(np.uint16) * np.uint16(256) + part[1:]
        size = b - a
        act = None
        for table, offset, double in tables:
            found = table[(pairs if double else part)[offset : offset + size]]
            act = found if act is None else np.add(act, found, out=act)
        # The last positions of a document would see the next one: they count as blank-free ends.
        for end in ends[(ends > a) & (ends <= b)]:
            act[end - a - WIDTH + 1 : end - a] = -np.inf
        cube = act.reshape(-1, HALF, len(shift))
        out[first : first + len(cube)] = np.maximum(cube.max(axis=1) + shift, 0)
        if places:
            where[first : first + len(cube)] = cube.argmax(axis=1) + (a + np.arange(len(cube)) * HALF)[:, None]
    return out, where


def _chunks(pooled: np.ndarray, halves: np.ndarray):
    """Chunk features, the half each comes from, and where each document's chunks start."""
    starts = np.cumsum(halves) - halves
    last = np.zeros(len(pooled), bool)
    last[starts + halves - 1] = True
    last[starts[halves == 1]] = False
    left = np.flatnonzero(~last)
    right = np.minimum(left + 1, len(pooled) - 1)
    right = np.where(np.isin(left, starts[halves == 1]), left, right)
    pick_right = pooled[right] > pooled[left]
    counts = np.maximum(halves - 1, 1)
    return np.where(pick_right, pooled[right], pooled[left]), np.where(pick_right, right[:, None], left[:, None]), np.cumsum(counts) - counts, counts


def logits(weights: Weights, pooled: np.ndarray, halves: np.ndarray) -> np.ndarray:
    chunk, _, starts, counts = _chunks(pooled, halves)
    mean = np.add.reduceat(chunk, starts) / counts[:, None]
    return (
        mean @ weights["mean"] + np.maximum.reduceat(chunk, starts) @ weights["max"]
        + np.minimum.reduceat(chunk, starts) @ weights["min"] + weights["bias"]
    )


def _gradient(weights: Weights, texts: Sequence[bytes], labels: np.ndarray) -> Weights:
    data, halves = padded(texts)
    pooled, where = pool_halves(data, halves, _tables(weights), weights["shift"].astype(np.float32), True)
    chunk, source, starts, counts = _chunks(pooled, halves)
    doc = np.repeat(np.arange(len(texts)), counts)
    mean = np.add.reduceat(chunk, starts) / counts[:, None]
    most, least = np.maximum.reduceat(chunk, starts), np.minimum.reduceat(chunk, starts)
    score = mean @ weights["mean"] + most @ weights["max"] + least @ weights["min"] + weights["bias"]
    error = (1 / (1 + np.exp(-score)) - labels) / len(texts)
    out = {"mean": error @ mean, "max": error @ most, "min": error @ least, "bias": np.array([error.sum()])}
    up = (error / counts)[doc, None] * weights["mean"] * np.ones_like(chunk)
    for name, value in (("max", most), ("min", least)):
        hit = chunk == value[doc]
        share = np.add.reduceat(hit, starts)[doc]
        up += np.where(hit, error[doc, None] * weights[name] / share, 0)
    up = np.where(chunk > 0, up, 0)
    f = np.broadcast_to(np.arange(chunk.shape[1]), chunk.shape)
    position = where[source, f]
    out["shift"] = up.sum(axis=0)
    tables = np.zeros((WIDTH, 256, chunk.shape[1]))
    for k in range(WIDTH):
        byte = data[np.minimum(position + k, len(data) - 1)]
        tables[k] = np.bincount((byte.astype(np.int64) * chunk.shape[1] + f).ravel(), up.ravel(), 256 * chunk.shape[1]).reshape(256, -1)
    out["vectors"] = np.einsum("kbf,kvf->bv", tables, weights["filters"])
    out["filters"] = np.einsum("kbf,bv->kvf", tables, weights["vectors"])
    return out


def _glimpse(text: bytes, random: np.random.Generator) -> bytes:
    """A text, or now and then a short stretch of it, so that short texts are learned as well."""
    if random.random() >= GLIMPSES:
        return text
    size = int(2 ** random.uniform(4, 9))
    at = int(random.integers(0, max(1, len(text) - size + 1)))
    return text[at : at + size]


def fit(texts: Sequence[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """Adam with decoupled weight decay over shuffled batches."""
    weights, random = new_weights(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step, total = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            gradient = _gradient(weights, [_glimpse(texts[i], random) for i in batch], labels[batch])
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for name, g in gradient.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                weights[name] = weights[name] - rate * (move + DECAY * weights[name])
    return weights


def score_texts(weights: Weights, tables, texts: Sequence[bytes]) -> np.ndarray:
    data, halves = padded(texts)
    pooled, _ = pool_halves(data, halves, tables, weights["shift"].astype(np.float32))
    return 1 / (1 + np.exp(-logits(weights, pooled, halves)))


# --- Spark --------------------------------------------------------------------------------


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the CRC-32 of the id's digits leaves the remainder that is kept out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, crop: int = CROP) -> DataFrame:
    """(text, label): at most ``max_rows`` of each class outside the held-out fold, cropped."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("__most"))
    known = known.where(F.col("label") == F.col("__most")).withColumn("draw", F.md5(F.col("doc_id").cast("string")))
    parts = [known.where(F.col("label") == v).orderBy("draw", "doc_id").limit(max_rows) for v in (0, 1)]
    # At most 2 * max_rows rows.
    sample = F.broadcast(stored(parts[0].unionByName(parts[1])).select("doc_id", "label", "draw"))
    text = F.coalesce("text", F.lit(""))
    room = F.greatest(F.length(text) - crop, F.lit(0))
    at = F.floor(room * F.conv(F.substring("draw", 1, 6), 16, 10).cast("double") / F.lit(float(2**24))).cast("int") + 1
    # Other columns of the table may have any name.
    return docs.select("doc_id", "text").join(sample, "doc_id").select("draw", text.substr(at, F.lit(crop)).alias("text"), "label")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, crop: int = CROP) -> Weights:
    """Fits on the bounded sample inside one task; only the weights come back.

    The bias is moved from the sample's balance to that of all labels outside the fold.
    """
    names = list(new_weights())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*batches, pd.DataFrame({"draw": [], "text": [], "label": []})])
        rows = rows.sort_values(["draw", "text"], kind="stable")
        label = rows["label"].to_numpy(np.float64)
        if len(set(label)) == 2:
            weights = fit([t.encode("utf-8", "replace") for t in rows["text"]], label)
            balance = np.log(label.sum() / (len(label) - label.sum()))
        else:
            weights = {k: np.zeros_like(v) for k, v in new_weights().items()}
            balance = 0.0
        weights["bias"] = weights["bias"] - balance
        yield pd.DataFrame({"name": names, "values": [weights[n].ravel() for n in names]})

    sample = training_rows(docs, labels, max_rows, crop).repartition(1)
    found = {r["name"]: np.array(r["values"]) for r in sample.mapInPandas(run, "name string, values array<double>").collect()}
    # Without any training row no task runs.
    weights = {k: found[k].reshape(v.shape) if found else np.zeros_like(v) for k, v in new_weights().items()}
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    zeros, ones = known.agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    weights["bias"] = weights["bias"] + np.log((ones + 1e-9) / (zeros + 1e-9)).clip(-6, 6)
    return weights


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(weights)
        for batch in batches:
            column = batch.column(2)
            scores = []
            for a in range(0, len(batch), 64):
                texts = [(t.as_py() or "").encode("utf-8", "replace") for t in column[a : a + 64]]
                scores.append(score_texts(weights, tables, texts))
            values = np.concatenate([np.zeros(0), *scores])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )
