"""Operators on single rows and lines: quality rules, line dedup, mixing, held to plain programs."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import line_dedup, mixing, quality

from . import cases

SPACE = " \t\n\x0b\f\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_figures(text):
    words, lines = words_of(text), (text or "").split("\n")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in lines:
        if words_of(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_base_figures_match_a_plain_count(spark):
    rows = quality.judge(cases.table(spark)).collect()
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert found == base_figures(r["text"]), r["text"]
        assert not (r["base_failed"] and r["kept"])
        assert r["odd.name"] == 1 and r["size"] == 7


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A sentence ends here.", False),
        ("He asked “why?” and left.", False),
        ("A sentence. Another without an end", False),
        ("no end at all in this line", True),
        ("BUY!! IT!! NOW!!", True),
        ("Home | About | Help.", True),
        ("One | bar in a long and ordinary line of prose.", False),
        ("wo*** rds&&& are$$$ odd.", True),
        ("All Rights Reserved.", True),
        ("", False),
        (" \t ", False),
    ],
)
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "text string")
    assert df.select(quality.line_fails(df["text"])).first()[0] == fails


def test_gutted_documents_are_rejected_and_clean_ones_keep_their_text(spark):
    good = " ".join(f"w{i}" for i in range(20)) + "."
    bad = " | ".join(f"menu{i}" for i in range(30))
    docs = cases.table(spark, [(1, good, "a"), (2, good + "\n" + bad, "a"), (3, good + "\nHome | Help | Login", "a")])
    kept = {r["doc_id"]: r for r in quality.keep_good(docs).collect()}
    assert sorted(kept) == [1, 3]
    assert kept[1]["text"] == kept[3]["text"] == good
    assert kept[3]["n_chars"] == len(good) and kept[3]["kept"] == "no" and kept[3]["odd.name"] == 1


def expected_lines(rows):
    last = 2**63 - 1
    holders, docs = defaultdict(set), []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        did = last if doc_id is None else doc_id
        keys = [line.strip(SPACE).translate(str.maketrans(line_dedup._UPPER, line_dedup._LOWER)) for line in lines]
        docs.append((doc_id, did, lines, keys))
        for key in keys:
            if len(key) >= 10:
                holders[key].add(did)
    out = []
    for doc_id, did, lines, keys in docs:
        kept = [x for x, k in zip(lines, keys) if len(holders[k]) < 2 or min(holders[k]) == did]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def test_line_dedup_matches_a_plain_program(spark):
    rows = line_dedup.dedup_lines(cases.table(spark)).collect()
    found = [
        (r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows
    ]
    assert sorted(found, key=repr) == expected_lines(cases.TEXTS)


def test_line_dedup_threshold(spark):
    line = "this line is in several documents"
    docs = cases.table(spark, [(i, line, "a") for i in (1, 2)] + [(i, line.upper() + " too", "a") for i in (3, 4, 5)])
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, min_docs=3).collect()}
    assert [left[i] != "" for i in (1, 2, 3, 4, 5)] == [True, True, True, False, False]


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares again and again, as the rule is worded."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(cap * sizes[s] for s in capped)
        share = sum(weight[s] for s in free)
        target = {s: cap * sizes[s] if s in capped else weight[s] * rest / share for s in order}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("rows", [cases.TEXTS, [(i, "w " * (i * i % 37 + 1), f"s{i % 7}") for i in range(200)]])
def test_mix_meets_targets(spark, rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words_of(text))
    want = targets(dict(sizes))
    mixed = mixing.mix(cases.table(spark, rows), keep=("doc_id", "source", "text")).collect()
    again = mixing.mix(cases.table(spark, rows[::-1]), keep=("doc_id", "source", "text")).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, again))
    taken = Counter()
    for r in mixed:
        assert r["size"] == len(words_of(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert len(r["places"]) == r["copies"] and all(0 <= p["position"] <= 1 for p in r["places"])
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1


def test_training_order_is_sorted_and_repeats_documents(spark):
    docs = cases.table(spark, [(i, "w " * 10, "abc"[i % 3] if i < 30 else "b") for i in range(60)])
    rows = mixing.training_order(docs).collect()
    positions = [r["position"] for r in rows]
    assert positions == sorted(positions)
    assert rows[0]["odd.name"] == 1 and rows[0]["size"] == 7
    mixed = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter({k: v for k, v in mixed.items() if v})


def test_position_inverts_demand(spark):
    a, b = 1.5, 0.5
    df = spark.createDataFrame([(x, 1000) for x in range(0, 1001, 100)], "start int, quota int")
    from pyspark.sql import functions as F

    for start, t in df.select("start", mixing.position(F.col("start"), F.col("quota"), F.lit(a), F.lit(b))).collect():
        assert (2 * a * t + (b - a) * t * t) / (a + b) * 1000 == pytest.approx(start)


def test_empty_tables(spark):
    docs = cases.empty(spark)
    assert quality.judge(docs).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert mixing.training_order(docs).count() == 0


def test_furniture_is_whole_words_and_a_share_of_the_line(spark):
    lines = {
        "All rights reserved.": True, "Copyright 2020 Someone. All rights reserved.": True, "Please sign in.": True,
        "Click here for more!": True, "She chose a design in blue.": False, "It is in the catalog in print.": False,
        "He wrote on his blog in May.": False, "They had a dialog in French.": False,
        "The court held that the privacy policy of the company was not part of the contract between them.": False,
    }
    table = spark.createDataFrame([(x,) for x in lines], "line string")
    found = table.select("line", quality.line_fails(F.col("line")).alias("fails")).collect()
    assert {r["line"]: r["fails"] for r in found} == lines


def test_the_sql_and_the_plain_program_fail_the_same_lines(spark):
    import duckdb

    from tallyloom.llm import oracles

    from .test_pipeline import line_fails

    lines = [
        "All rights reserved.", "Sign in, log in, sign in.", "sign in log in click here.", "He said: sign in now or go away today.",
        "The privacy policy of the company was not part of the contract between them.", "A design in blue.", "(sign in).",
        "a$b c d.", "a$b$ c.", "$$$ d e f.", "x" * 50 + "#" + "y" * 50 + ".", "#", "", "cookie policy|privacy policy.",
    ]
    table = spark.createDataFrame([(x,) for x in lines], "l string")
    found = {r["l"]: r["fails"] for r in table.select("l", quality.line_fails(F.col("l")).alias("fails")).collect()}
    db = duckdb.connect()
    sql = {x: db.execute(f"SELECT {oracles._fails('l')} FROM (SELECT ?::VARCHAR AS l)", [x]).fetchone()[0] for x in lines}
    assert found == sql == {x: line_fails(x) for x in lines}
    assert found["sign in log in click here."] and not found[lines[3]] and not found[lines[4]]


def test_a_word_of_a_million_letters_takes_seconds(spark):
    import time

    rows = [(1, "x" * 1_000_000 + ".", "a"), (2, "." * 1_000_000, "a"), (3, "a$" * 500_000 + " and more.", "a")]
    started = time.monotonic()
    found = cases.plain(quality.judge(cases.table(spark, rows)).select("doc_id", "n_words", "n_bad_lines", "kept"))
    assert time.monotonic() - started < 10
    assert found == [(1, 1, 0, False), (2, 1, 0, False), (3, 3, 1, False)]
