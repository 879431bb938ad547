"""Near-duplicate texts and vectors against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tallyloom.llm import common, ngram_join, vector_dedup
from tallyloom.llm.small_world import SmallWorld

from . import cases


def reachable(links):
    least = {}
    for node in links:
        seen, todo = {node}, [node]
        while todo:
            for other in links[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        least[node] = min(seen)
    return least


def grams_of(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard_rows(rows):
    """What near_duplicates should return for rows (doc_id, text), by comparing everything."""
    taking = [i for i, (d, t) in enumerate(rows) if d is not None and grams_of(t)]
    sets = {i: grams_of(rows[i][1]) for i in taking}
    links = {
        i: {j for j in taking if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in taking
    }
    root = reachable(links)
    groups = {}
    for i in taking:
        groups.setdefault(root[i], []).append(rows[i][0])
    out = []
    for i, (doc_id, text) in enumerate(rows):
        if i not in sets:
            out.append((doc_id, doc_id, 0, doc_id, True))
            continue
        same = min(d for d, t in rows if t == text and d is not None)
        cls = min(groups[root[i]])
        out.append((doc_id, same, len(links[i]), cls, cls == doc_id))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    found = cases.plain(ngram_join.near_duplicates(cases.table(spark)))
    assert found == jaccard_rows([(d, t) for d, t, _ in cases.TEXTS])
    assert ngram_join.near_duplicates(cases.empty(spark)).count() == 0
    assert ngram_join.drop_near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("block", [4, 256])
def test_copies_of_many_kinds_match_brute_force(spark, block):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for size in (8, 40, 120, 300):
        for _ in range(4):
            base = [rng.choice(words) for _ in range(size)]
            for _ in range(rng.randrange(1, 9)):
                copy = list(base)
                for _ in range(rng.randrange(0, 1 + size // 25)):
                    copy[rng.randrange(len(copy))] = rng.choice(words)
                rows.append((number, " ".join(copy)))
                number += 1
    rng.shuffle(rows)
    docs = cases.table(spark, [(d, t, "a") for d, t in rows])
    want = jaccard_rows(rows)
    assert cases.plain(ngram_join.near_duplicates(docs, block=block)) == want
    left = ngram_join.drop_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in want if r[4])
    assert left.columns == docs.columns


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands()
    assert bands * rows <= ngram_join.MAX_HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= ngram_join.TARGET_RECALL
    longer = math.ceil(math.log(1 - ngram_join.TARGET_RECALL) / math.log(1 - 0.8 ** (rows + 1)))
    assert longer * (rows + 1) > ngram_join.MAX_HASHES


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n)).astype(np.uint64) for n in (1, 5, 3000, 6000, 8000)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets]
    assert ngram_join.shared_counts(sets, sets[2:]).tolist() == want


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"x{i}") for i in range(50)] + [("s", "s"), ("t", "u"), ("u", "t")]
    found = dict(map(tuple, common.components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()))
    links = {}
    for a, b in edges:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    assert found == reachable(links)


def vector_rows(rows):
    """What near_vectors should return for rows (vec_id, embedding, label)."""
    good = {}
    for i, (vec_id, v, label) in enumerate(rows):
        if vec_id is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float) / np.linalg.norm(v)
    links = {
        i: {j for j in good if j != i and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.98}
        for i in good
    }
    root = reachable(links)
    least = {}
    for i in good:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        cls = least[root[i]] if i in good else vec_id
        out.append((vec_id, len(links.get(i, ())), cls, vec_id is None or cls == vec_id))
    return sorted(out, key=repr)


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "vec_id long, embedding array<float>, label int, node int, unit string, shard int")


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 0), (5, None, 0),
        (6, [], 0), (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (None, [1.0, 0.0], 0),
        (11, [1.0, 0.0], None), (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [1e-30, 0.0], 0), (None, None, None),
    ]
    assert cases.plain(vector_dedup.near_vectors(make(spark, rows))) == vector_rows(rows)
    assert vector_dedup.near_vectors(make(spark, [])).count() == 0


@pytest.mark.parametrize("shard", [60, 8192])
def test_vectors_match_brute_force(spark, shard):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(120, 16))
    rows = []
    for i in range(600):
        v = base[0 if i % 3 == 0 else rng.integers(0, 120)] + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 2)))
    found = cases.plain(vector_dedup.near_vectors(make(spark, rows), shard=shard, beam=4))
    want = vector_rows(rows)
    missed = sum(abs(a[1] - b[1]) for a, b in zip(found, want))
    assert all(a[1] <= b[1] for a, b in zip(found, want))
    assert missed <= 0.01 * sum(r[1] for r in want)
    if not missed:
        assert found == want


def test_graph_recall():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids, _ = SmallWorld(x).search(x[:300], 48)
    exact = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    hits = sum(len(set(a.tolist()) & set(b.tolist())) for a, b in zip(exact, ids))
    assert hits / exact.size >= 0.9
    assert Counter(len(level) for level in SmallWorld(x[:1]).levels).keys() == {1}


class Blind:
    """A graph whose walks find nothing but the first member."""

    def search(self, queries, beam):
        ids = np.full((len(queries), beam), -1)
        sims = np.full((len(queries), beam), -np.inf)
        ids[:, 0], sims[:, 0] = 0, 0.0
        return ids, sims


def sphere(rng, *shape):
    x = rng.normal(size=shape)
    return x / np.linalg.norm(x, axis=-1)[..., None]


def test_audits_see_links_where_the_table_has_none():
    x = sphere(np.random.default_rng(6), 1500, 32)
    probes = vector_dedup.probes(x, 0.98, 200)
    assert np.allclose(np.linalg.norm(probes, axis=1), 1)
    assert ((probes[200:] * probes[:200]).sum(axis=1) >= 0.98).all()
    # A graph that finds nothing is found out, and the shard is scanned.
    beam, audited, found = vector_dedup.audited_beam(Blind(), x, 0.98, 16, 0.999, 200)
    assert beam * 8 >= len(x) and audited == found >= 400
    queries = sphere(np.random.default_rng(7), 1500, 32)
    queries[[101, 702, 1303]] = x[[5, 6, 7]]
    q, m = vector_dedup.find_links(Blind(), x, queries, 0.98, beam)
    assert sorted(zip(q.tolist(), m.tolist())) == [(101, 5), (702, 6), (1303, 7)]
    # One dimension leaves no way aside.
    assert (vector_dedup.probes(np.array([[1.0], [-1.0]]), 0.98, 5) ** 2 == 1).all()


def test_none_links_with_itself():
    x = sphere(np.random.default_rng(7), 1500, 32)
    x[1400] = x[3]
    graph = SmallWorld(x)
    q, m = vector_dedup.find_links(graph, x, x, 0.98, 16, own=True)
    assert sorted(zip(q.tolist(), m.tolist())) == [(3, 1400), (1400, 3)]


def test_graphs_answer_where_links_are_few(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = sphere(rng, 4500, 32)
    copies = rng.permutation(4500)[:240].reshape(2, 120)
    x[copies[1]] = x[copies[0]] + 0.01 * rng.normal(size=(120, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    truth = x @ x.T >= 0.98
    np.fill_diagonal(truth, False)
    assert 200 <= truth.sum() <= 400

    # In the tasks of one label: three shards, every pair of them asked both ways.
    place, graphs = rng.integers(0, 3, 4500), {}
    for s in range(3):
        rows = np.flatnonzero(place == s)
        group = pd.DataFrame({"node": [f"{i:05}" for i in rows], "unit": list(x[rows]), "label": "a", "dims": 32, "shard": s})
        graphs[s] = vector_dedup._build(group).assign(copies=[[1] * len(rows)])
    walked, scanned = [], []
    search, scan = SmallWorld.search, vector_dedup.scan
    monkeypatch.setattr(SmallWorld, "search", lambda self, queries, beam: (walked.append(len(queries)), search(self, queries, beam))[1])
    monkeypatch.setattr(vector_dedup, "scan", lambda x, queries, rows, t: (scanned.append(len(rows)), scan(x, queries, rows, t))[1])
    n_links = Counter()
    for low in range(3):
        for high in range(low, 3):
            pair = pd.concat([graphs[low]] + [graphs[high]] * (low != high)).assign(low=low, high=high)
            for node, links, _ in vector_dedup._query(0.98)(pair).itertuples(index=False):
                n_links[int(node)] += links
    assert sum(walked) == 3 * 4500 and sum(scanned) <= 0.05 * sum(walked)
    assert [n_links[i] for i in range(4500)] == truth.sum(axis=1).tolist()
    assert sum(g["found"].item() for g in graphs.values()) >= 0.999 * sum(g["audited"].item() for g in graphs.values())

    monkeypatch.undo()
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    found = cases.plain(vector_dedup.near_vectors(make(spark, rows), shard=1500))
    assert [r[1] for r in sorted(found)] == truth.sum(axis=1).tolist()


def test_links_between_shards_count_at_both_ends(monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2, 300, 16))
    x[1, 40] = x[0, 7]
    x /= np.linalg.norm(x, axis=2)[:, :, None]
    rows = []
    for s in (0, 1):
        group = pd.DataFrame({"node": [f"{i:03}-{s}" for i in range(300)], "unit": list(x[s]), "label": 0, "dims": 16, "shard": s})
        rows.append(vector_dedup._build(group).assign(copies=[[2 + s] * 300], low=0, high=1))
    find, asked = vector_dedup.find_links, []

    def from_one_end(graph, *rest):
        q, m = find(graph, *rest)
        asked.append(len(q))
        return (q, m) if len(asked) == 1 else (q[:0], m[:0])

    monkeypatch.setattr(vector_dedup, "find_links", from_one_end)
    found = vector_dedup._query(0.98)(pd.concat(rows))
    assert asked == [1, 1]
    assert found.values.tolist() == [["007-0", 3, "007-0"], ["040-1", 2, "007-0"]]


def test_one_row_of_each_group_stays(spark):
    a, b = cases.SENTENCE + " One two three four five six seven eight nine ten.", "Quite another sentence, which has nothing to do with the first."
    near = cases.SENTENCE + " One two three four five six seven eight nine ten. Eleven"
    rows = [
        (1, a, "a"), (1, a, "a"), (1, near, "a"), (2, a, "b"), (None, a, "c"), (None, near, "c"),
        (None, b, "d"), (None, b, "d"), (5, None, "e"), (5, None, "e"), (None, " ", "e"), (7, "alone here", "f"), (7, "alone here", "f"),
    ]
    left = ngram_join.drop_near_duplicates(cases.table(spark, rows))
    found = [(r["doc_id"], r["text"]) for r in left.collect()]
    group = [r for r in found if r[1] in (a, near)]
    assert len(group) == 1 and group[0][0] == 1
    rest = [r for r in found if r not in group]
    assert sorted(rest, key=repr) == sorted([(None, b), (5, None), (5, None), (None, " "), (7, "alone here")], key=repr)
