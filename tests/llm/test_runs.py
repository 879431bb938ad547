"""Periodic runs against comparing every word with the one a period later."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import periodic_runs
from tallyloom.llm.queries import QUERIES

from . import cases, fixtures


def plain_runs(words, least=12):
    found = {}
    for period in range(len(words) // 2, 0, -1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - at + period >= max(least, 2 * period):
                found[at, end - at + period] = period
            at = end + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def runs(*texts):
    return [[tuple(r) for r in found.tolist()] for found in periodic_runs.runs([[w.encode() for w in t] for t in texts])]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.lists(
            st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=11), st.integers(1, 5)), max_size=6
        ).map(lambda parts: [w for part, times in parts for w in part * times]),
        min_size=1, max_size=4,
    )
)
def test_runs_of_periodic_texts(texts):
    assert runs(*texts) == [plain_runs(t) for t in texts]


def test_random_and_fibonacci_texts():
    random = np.random.default_rng(11)
    texts = [list(random.choice(list("ab"), 150)) for _ in range(100)]
    texts += [list(random.choice(list("abc"), 150)) for _ in range(50)]
    word, nxt = "a", "ab"
    while len(nxt) < 400:
        word, nxt = nxt, nxt + word
    texts += [list(nxt), list(nxt[7:]), list("ab" * 100 + "a" * 100 + "ab" * 50)]
    assert runs(*texts) == [plain_runs(t) for t in texts]


def test_periods_whose_every_factor_is_periodic_itself():
    # The nearest equal stretch is never a period away here.
    for word in ("0101010", "01010101010", "0001000100010", "00010000100001"):
        for before, after in (("", ""), ("01", "1010"), ("2", "2")):
            text = list(before + word * 2 + after)
            assert runs(text) == [plain_runs(text)]


def test_runs_end_with_their_text():
    assert runs(["a"] * 6, ["a"] * 6, ["a"] * 12, [], ["a"] * 11) == [[], [], [(0, 12, 1)], [], []]
    long = ["w%d" % (i % 997) for i in range(20_000)]
    assert runs(long) == [[(0, 20_000, 997)]]
    assert runs(["a"] * 200_000) == [[(0, 200_000, 1)]]
    with pytest.raises(ValueError):
        periodic_runs.runs([[]], min_length=7)


def expected(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if doc_id is not None and words:
        checksum = zlib.crc32(str(doc_id).encode())
        if checksum % 10 == 0:
            group = checksum // 10
            a = group % len(words)
            period = 1 + (len(words) - a) // (3 + group % 8)
            words = [w if i < a else words[a + (i - a) % period] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_awkward_rows(spark, tmp_path):
    rows = [r for r in cases.TEXTS if r[1] != cases.LONG]
    rows += [(i, " ".join(f"w{k % (i % 17 + 1)}" for k in range(60)) + " end é　x", "a") for i in range(100, 160)]
    rows += [(200 + i, " ".join(f"u{(k * k) % 31}" for k in range(80)), "b") for i in range(60)]
    found = QUERIES["op12_periodic_runs"](spark, fixtures.folder(spark, tmp_path / "t", rows))
    assert cases.plain(found.select(COLUMNS)) == sorted((expected(i, t) for i, t, _ in rows), key=repr)
    empty = QUERIES["op12_periodic_runs"](spark, fixtures.folder(spark, tmp_path / "e", []))
    assert empty.count() == 0 and empty.columns == COLUMNS


def test_general_interface_gives_runs_and_texts(spark):
    rows = [(1, "x " + "a b c " * 5 + "y", "a"), (1, None, "a"), (None, "", "a")]
    found = periodic_runs.find_runs(cases.table(spark, rows)).collect()
    assert sorted((repr(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found) == [
        ("1", [], ""), ("1", [(1, 15, 3)], "x a b c y"), ("None", [], ""),
    ]
