"""Trained operators: the byte-level network and the licence classifier; and URL filters."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import byte_cnn, licenses, url_filters

from . import cases


def loss(weights, texts, labels):
    data, halves = byte_cnn.padded(texts)
    pooled, _ = byte_cnn.pool_halves(data, halves, byte_cnn._tables(weights), weights["shift"].astype(np.float32))
    z = byte_cnn.logits(weights, pooled, halves)
    return float(np.mean(np.log1p(np.exp(z)) - labels * z))


@pytest.mark.parametrize("name", ["filters", "vectors", "shift", "mean", "max", "min", "bias"])
def test_gradients(name):
    weights = byte_cnn.new_weights()
    texts, labels = [b"a short text", cases.LONG.encode()[:900], b"", b"x" * 128, b"y" * 129], np.array([1.0, 0, 1, 0, 1])
    gradient = byte_cnn._gradient(weights, texts, labels)[name]
    place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
    value, step, around = weights[name][place], 1e-3, []
    for sign in (1, -1):
        weights[name][place] = value + sign * step
        around.append(loss(weights, texts, labels))
    assert gradient[place] == pytest.approx((around[0] - around[1]) / (2 * step), rel=0.02, abs=1e-4)


def test_convolution_covers_every_byte_of_every_text():
    weights = byte_cnn.new_weights(3)
    tables, shift = byte_cnn._tables(weights), weights["shift"].astype(np.float32)
    filters = np.einsum("bv,kvf->kbf", weights["vectors"], weights["filters"])
    texts = [b"", b"abc", bytes(range(200)) * 2, b"q" * 128, cases.LONG.encode()[: byte_cnn._BLOCK + 300]]
    data, halves = byte_cnn.padded(texts)
    pooled, _ = byte_cnn.pool_halves(data, halves, tables, shift)
    at = 0
    for text, count in zip(texts, halves):
        blank = np.frombuffer(text.ljust(count * byte_cnn.HALF, b"\0"), np.uint8)
        act = sum(filters[k][blank[k : len(blank) - byte_cnn.WIDTH + 1 + k]] for k in range(byte_cnn.WIDTH))
        for h in range(count):
            part = act[h * byte_cnn.HALF : (h + 1) * byte_cnn.HALF]
            assert np.allclose(pooled[at + h], np.maximum(part.max(axis=0), 0), atol=1e-4)
        at += count
    alone = [byte_cnn.score_texts(weights, tables, [t])[0] for t in texts]
    assert np.allclose(alone, byte_cnn.score_texts(weights, tables, texts), atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = byte_cnn.score(docs, byte_cnn.train(docs, labels)).toPandas()
    assert scored["score"].between(0, 1).all() and len(scored) == docs.count()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored["doc_id"]]).all()
    rows = scored.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert (rows["predicted"] == rows["quality"]).mean() >= 0.95
    rank = rows["score"].rank()
    ones, zeros = (rows["quality"] == 1).sum(), (rows["quality"] == 0).sum()
    assert (rank[rows["quality"] == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros) >= 0.98


def test_classifier_cases(spark):
    docs = cases.table(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = byte_cnn.score(docs, byte_cnn.train(docs, none)).toPandas()
    assert np.allclose(scores["score"], 0.5) and len(scores) == len(cases.TEXTS)
    some = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (None, 1, 0), (6, None, 0), (8, 1, 0), (9, 0, 0), (12, 0, 0), (13, 1, 0)], "doc_id long, quality int, toxic int"
    )
    used = {r["label"] for r in byte_cnn.training_rows(docs, some).collect()}
    assert used <= {0, 1}
    again = [byte_cnn.score(docs, byte_cnn.train(docs, some)).orderBy("doc_id", "score").toPandas() for _ in range(2)]
    assert again[0].equals(again[1])
    assert byte_cnn.score(cases.empty(spark), byte_cnn.train(cases.empty(spark), none)).count() == 0


@pytest.fixture(scope="module")
def licence_model(spark):
    return licenses.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


LINES = [
    ("Released under the MIT License.", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("This work is licensed under the GNU Affero General Public License, version 3", "agpl"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Copyright 2020 Someone. All rights reserved.", "proprietary"),
    ("She asked for permission to park near the gate.", None),
    ("The warranty on the kettle ended in June.", None),
    ("", None),
    (cases.LONG, None),
]


def test_licence_families(spark, licence_model):
    model, least = licence_model
    found = licenses.classify(spark.createDataFrame([(p,) for p, _ in LINES], "paragraph string"), model, least)
    answer = {r["paragraph"]: r["family"] if r["confirmed"] else None for r in found.collect()}
    assert answer == dict(LINES)


def test_probabilities_match_a_plain_regression(spark, licence_model):
    model, _ = licence_model
    table = licenses.with_grams(spark.createDataFrame([(p,) for p, _ in LINES], "paragraph string"))
    scored = model.transform(table).select("grams", "probability").collect()
    vocabulary = {g: i for i, g in enumerate(model.stages[0].vocabulary)}
    weights, base = model.stages[1].coefficientMatrix.toArray(), model.stages[1].interceptVector.toArray()
    for grams, probability in scored:
        z = base + sum((weights[:, vocabulary[g]] for g in set(grams) if g in vocabulary), np.zeros(len(base)))
        e = np.exp(z - z.max())
        assert np.allclose(e / e.sum(), probability.toArray(), atol=1e-6)


def test_scan_finds_every_announcement_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r["families"] for r in licenses.scan(docs).collect()}
    phrases = {p: f for p, f in LINES if f} | {"All rights reserved.": "proprietary", "Licensed under the Apache License, Version 2.0.": "apache-2.0"}
    want = {
        r["doc_id"]: sorted({phrases[x] for x in r["text"].split("\n") if x in phrases}) for r in docs.select("doc_id", "text").collect()
    }
    assert found == want


def test_scan_cases(spark):
    rows = [(1, "Prose here.\nReleased under the MIT License.\nAll rights reserved.", "a"), *cases.TEXTS]
    found = licenses.scan(cases.table(spark, rows)).collect()
    assert len(found) == len(rows)
    assert Counter(tuple(r["families"]) for r in found) == {(): len(rows) - 1, ("mit", "proprietary"): 1}
    spans = next(r["spans"] for r in found if r["families"])
    assert [(s["line"], s["family"]) for s in spans] == [(1, "mit"), (2, "proprietary")]
    assert licenses.scan(cases.empty(spark)).count() == 0


def test_every_ordinary_paragraph_is_learned_from_or_calibrated_on(spark):
    lines = ["Any copy of the work, as is.", "of the general public (free of charge) and or of the", "日本語 the. on an \"as is\" basis", "nothing"]
    docs = [(i if i % 9 else None, f"{lines[i % 4]}\n \n{lines[i % 3]}\nunder the MIT license", "a") for i in range(600)]
    prose = licenses.ordinary(cases.table(spark, [*docs, (5, None, "a"), (5, "", "a")]))
    assert prose.count() == 1200
    known = licenses.with_grams(licenses.templates(spark)).select(F.explode("grams").alias("g")).distinct()
    vocabulary = sorted(r["g"] for r in known.collect())
    want = Counter()
    for r in licenses.with_grams(prose).collect():
        want[r["draw"][0] >= "8", tuple(sorted(set(r["grams"]) & set(vocabulary)))] += 1
    got = {(r["held_out"], tuple(r["grams"])): r["n"] for r in licenses.profiles(prose, vocabulary).collect()}
    assert got == dict(want) and {held_out for held_out, _ in got} == {True, False}


def test_the_level_counts_every_held_out_paragraph(spark):
    # Ordinary words that read like a family's, in a few documents among very many.
    close = "this work is free and unencumbered software released into the domain"
    docs = [(i, "plain words about hills" if i % 60 else close, "a") for i in range(1200)]
    model, least = licenses.train(cases.table(spark, docs))
    without, lowest = licenses.train(cases.table(spark, [d for d in docs if d[1] != close]))
    assert lowest == licenses.LEAST_PROBABILITY <= least <= 0.95
    held_out = licenses.ordinary(cases.table(spark, docs)).where("substring(draw, 1, 1) >= '8'")
    best = licenses.classify(held_out.select("paragraph"), model, 0.0).agg(F.max("probability")).first()[0]
    assert least == pytest.approx(max(0.5, min(0.95, best)), abs=1e-6)


URLS = [
    ("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("https://www.example.com/en/y", "www.example.com", "/en/y", "www.example.com/en/", "allow"),
    ("https://sub.www.example.com/en/", "sub.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://x.com", "x.com", "", None, None),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net?es/", "x.net", "", None, None),
    ("ftp://h#frag://z/", "h", "", None, None),
    ("no scheme/en/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http:///p", "", "/p", None, None),
]


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "h", "p", "r", "v", 0) for r in rows], "page_id long, url string, html string, host string, path string, rule string, verdict string, trust int"
    )


def test_rules(spark):
    found = url_filters.with_rules(pages(spark, [(i, u[0], None) for i, u in enumerate(URLS)])).orderBy("page_id").collect()
    assert [(r["url"], r["host"], r["path"], r["rule"], r["rule_verdict"]) for r in found] == URLS


def plain_ranks(edges, seeds, rounds, damping):
    scale = url_filters.SCALE // 100
    out, back = Counter(), Counter()
    for (s, d), w in edges.items():
        out[s] += w
        back[d] += w
    allowed, blocked = sum(a for a, _ in seeds.values()), sum(b for _, b in seeds.values())
    base = {h: [scale * a // allowed * 100 if allowed else 0, scale * b // blocked * 100 if blocked else 0] for h, (a, b) in seeds.items()}
    ranks = dict(base)
    for _ in range(rounds):
        new = {h: [t * (100 - damping) // 100, d * (100 - damping) // 100] for h, (t, d) in base.items()}
        for (s, d), w in edges.items():
            if s in ranks:
                new.setdefault(d, [0, 0])[0] += ranks[s][0] * damping // 100 * w // out[s]
            if d in ranks:
                new.setdefault(s, [0, 0])[1] += ranks[d][1] * damping // 100 * w // back[d]
        ranks = new
    return ranks


def test_trust_and_distrust_flow_over_links(spark):
    link = "<a HREF='{}'>x</a>".format
    rows = [
        (1, "http://good.com/a", link("http://friend.org/") + link("//friend.org/b") + link("/own")),
        (2, "http://friend.org/", '<a href="https://second.org/x">'),
        (3, "http://second.org/", None),
        (4, "http://bad.net/es/1", link("http://good.com/")),
        (5, "http://points.org/", link("http://bad.net/es/1") + link("http://bad.net/fr/")),
        (6, "http://alone.org/", ""),
        (7, None, link("http://bad.net/")),
        (7, None, None),
    ]
    found = url_filters.judge(pages(spark, rows)).collect()
    verdict = {r["host"]: r["verdict"] for r in found}
    assert verdict == {
        "good.com": "allow", "friend.org": "allow", "second.org": "allow", "bad.net": "block", "points.org": "block", "alone.org": "allow", "": "allow",
    }
    edges = {
        ("good.com", "friend.org"): 2, ("friend.org", "second.org"): 1, ("bad.net", "good.com"): 1, ("points.org", "bad.net"): 2,
    }
    hosts = {r["host"] for r in found if r["host"]}
    seeds = {h: (int(h == "good.com"), int(h == "bad.net")) for h in hosts}
    want = plain_ranks(edges, seeds, url_filters.ROUNDS, url_filters.DAMPING_PERCENT)
    unit = url_filters.SCALE // url_filters.REPORTED
    assert {r["host"]: [r["trust"], r["distrust"]] for r in found if r["host"]} == {h: [x // unit for x in want[h]] for h in hosts}


def test_empty_pages(spark):
    assert url_filters.judge(pages(spark, [])).count() == 0
    found = spark.createDataFrame([("http://a.b.c.org/",)], "url string").select(url_filters.host_of(F.col("url")).alias("host"))
    edges = url_filters.host_edges(spark.createDataFrame([], "url string, html string"), found).collect()
    assert sorted((r["src"], r["dst"], r["weight"]) for r in edges) == [("a.b.c.org", "b.c.org", 1), ("b.c.org", "a.b.c.org", 1)]


def ranked(spark, edges, seeds, **options):
    ranks = url_filters.propagate(
        spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, weight long"),
        spark.createDataFrame([(h, *n) for h, n in seeds.items()], "host string, allowed long, blocked long"), **options,
    )
    return {r["host"]: [int(r["trust"]), int(r["distrust"])] for r in ranks.collect()}


def test_hubs_pass_on_every_share(spark):
    links = 3_000_000
    edges = {
        ("hub.com", "large.com"): links - 2, ("hub.com", "a.com"): 1, ("hub.com", "b.com"): 1, ("c.com", "hub.com"): 1,
        ("large.com", "hub.com"): links,
    }
    seeds = {"hub.com": (1, 0), "a.com": (0, 1)}
    found = ranked(spark, edges, seeds, rounds=3)
    assert found == plain_ranks(edges, seeds, 3, url_filters.DAMPING_PERCENT)
    assert found["a.com"][0] == found["b.com"][0] > 0 and found["c.com"][1] > 0


def test_trust_of_a_small_seed_in_a_large_web_goes_on(spark):
    # Ten of 10^9 allowed pages, fifty links a host: trust is there on the third hop.
    name = "h{}.com".format
    edges = {(name(k), name(f"{k + 1}-{i}" if i else k + 1)): 1 for k in range(4) for i in range(50)}
    seeds = {name(0): (10, 0), "rest.com": (10**9 - 10, 3)}
    found = ranked(spark, edges, seeds, rounds=5)
    assert found == plain_ranks(edges, seeds, 5, url_filters.DAMPING_PERCENT)
    exact = url_filters.SCALE * 1e-8 * 0.15
    for hop in range(1, 4):
        exact *= 0.85 / 50
        assert found[name(hop)][0] == pytest.approx(exact, rel=1e-6) and exact > 0


def test_rounds_leave_less_than_the_residual(spark):
    name = "h{:02}.com".format
    edges = {(name(i), name((i + 1) % 30)): 1 for i in range(30)}
    seeds = {name(0): (1, 0)}
    found = ranked(spark, edges, seeds)
    settled = plain_ranks(edges, seeds, 300, url_filters.DAMPING_PERCENT)
    assert found == plain_ranks(edges, seeds, url_filters.ROUNDS, url_filters.DAMPING_PERCENT)
    assert sum(abs(found[h][0] - settled[h][0]) for h in settled) <= 2 * url_filters.RESIDUAL * url_filters.SCALE


def test_totals_meet_seeds_without_a_cross_join(spark, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    stored = url_filters.stored
    monkeypatch.setattr(url_filters, "stored", kept)
    ranked(spark, {("a.com", "b.com"): 1}, {"a.com": (1, 0), "b.com": (0, 1)}, rounds=2)
    assert len(plans) == 5 and not any("NestedLoop" in p or "Cartesian" in p for p in plans)


def test_paragraphs_without_an_anchor_are_scored(spark):
    line = "source and binary forms with or without modification are permitted provided that the following conditions are met"
    assert not spark.createDataFrame([(line,)], "paragraph string").where(F.col("paragraph").rlike(licenses.ANCHOR)).count()
    # Equal rows are rows of their own, and each has its licence once.
    docs = [(1, f"a word\n{line}", "a"), (1, f"a word\n{line}", "a"), (2, "nothing of that kind here", "a")]
    found = licenses.scan(cases.table(spark, docs)).collect()
    got = sorted((r["doc_id"], r["n_candidates"], r["n_confirmed"], tuple(r["families"]), r["spans"] and r["spans"][0]["line"]) for r in found)
    assert got == [(1, 0, 1, ("bsd",), 1), (1, 0, 1, ("bsd",), 1), (2, 0, 0, (), None)]
