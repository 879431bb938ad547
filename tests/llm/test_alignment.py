"""Alignment of two tokenizers against sets of byte ends, text by text."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import alignment
from tallyloom.llm.queries import QUERIES

from . import cases, fixtures

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [
    "a", "b", " ", "\n", "  ", "\t", "é", "é", "Σ", "<|endoftext|>", "日本", "'s", "1", "23", "!?", " ", "　",
    "\x00", "\x85", "word", "the", "\r\n", "<0x41>", "<s>", " \n", "\n\n", "😀",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """(id, bytes) of every token of A and of B."""
    tokenizer, model = libraries
    if not text:
        return [], []
    encoded = tokenizer.encode(" " + text, add_special_tokens=False)
    byte = alignment._byte_level()
    a = [(i, bytes(byte[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes.fromhex(piece[3:5]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
        return [], []
    return a, b


def groups(a, b):
    """Lists (ids of A, ids of B) between byte offsets where tokens of both end."""
    ends_a, ends_b = (np.cumsum([len(t) for _, t in side]).tolist() for side in (a, b))
    out, was_a, was_b = [], 0, 0
    place_a, place_b = ({end: n + 1 for n, end in enumerate(ends)} for ends in (ends_a, ends_b))
    for end in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = place_a[end], place_b[end]
        out.append(([i for i, _ in a[was_a:to_a]], [i for i, _ in b[was_b:to_b]]))
        was_a, was_b = to_a, to_b
    return out


def shown(parts):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in parts)


def check(libraries, texts):
    pair = alignment._pair(A, B)
    for text, row in zip(texts, pair.align(texts)):
        a, b = tokens(libraries, text)
        parts = groups(a, b)
        assert row[0].tolist() == [i for i, _ in a] and row[1].tolist() == [i for i, _ in b]
        assert list(zip(row[0][row[2]].tolist(), row[1][row[3]].tolist())) == [(x[-1], y[-1]) for x, y in parts]
        if a:
            assert pair.listed(*row) == shown(parts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=80).map("".join), max_size=5))
def test_any_text_aligns_like_sets_of_ends(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    check((tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)), texts)


def test_rows_that_do_not_come_back_have_no_tokens(libraries):
    texts = ["plain words", "a ▁ b", None, "", "▁", "more words here"]
    check(libraries, texts)
    found = alignment._pair(A, B).align(texts)
    assert [len(r[0]) > 0 for r in found] == [True, False, False, False, False, True]


def test_lanes_split_long_documents_without_a_trace():
    random = np.random.default_rng(2)
    sizes_a = [random.integers(1, 9, int(n)) for n in (4000, 1, 700, 30)]
    ends_b = []
    # B ends at A's ends or elsewhere, and always with the document.
    docs_b, total, flat_b = [], 0, []
    for sizes in sizes_a:
        size = int(sizes.sum())
        inner = np.flatnonzero(random.random(size - 1) < 0.3) + 1 if size > 1 else np.zeros(0, int)
        flat_b += (total + np.concatenate([inner, [size]])).tolist()
        docs_b.append(len(flat_b))
        total += size
    ends_a, ends_b = np.cumsum(np.concatenate(sizes_a)), np.array(flat_b)
    docs_a = np.cumsum([len(s) for s in sizes_a])
    common = np.intersect1d(ends_a, ends_b)
    for lane in (1, 7, 100, 10_000):
        a, b = alignment.aligned(ends_a, ends_b, docs_a, np.array(docs_b), lane)
        assert ends_a[a].tolist() == common.tolist() and ends_b[b].tolist() == common.tolist()
        starts, stops = alignment._lanes(ends_a, ends_b, docs_a, np.array(docs_b), lane)
        assert len(starts) >= len(docs_a) and set(docs_a) <= set(stops.tolist())
    # One end is shared in a long document: its lane is the document.
    lone = np.arange(2, 4002, 2)
    a, b = alignment.aligned(lone, np.array([1, 4000]), np.array([2000]), np.array([2]), 10)
    assert a.tolist() == [1999] and b.tolist() == [1]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_query_on_awkward_rows(spark, tmp_path, libraries):
    rows = [*cases.TEXTS, (20, "a<|endoftext|>b", "a"), (21, "x ▁ y", "a"), (22, "日本語" * 800 + " the", "b")]
    rows += [(30 + i, f"the cat number {i} sat; the dog did.", "a") for i in range(40)]
    found = QUERIES["op11_cross_tokenizer_alignment"](spark, fixtures.folder(spark, tmp_path / "t", rows))
    aligned = [(i, *tokens(libraries, t)) for i, t, _ in rows]
    links = [[(x[-1], y[-1]) for x, y in groups(a, b)] for _, a, b in aligned]
    counts = Counter(link for own in links for link in own)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = []
    for (doc_id, a, b), own in zip(aligned, links):
        digest = hashlib.sha256(shown(groups(a, b)).encode()).hexdigest() if a else ""
        best = sum(counts[link] == most[link[1]] for link in own)
        want.append((doc_id, len(a), len(b), len(own), len(own), digest, best, sum(counts[link] for link in own)))
    assert cases.plain(found.select(COLUMNS)) == sorted(want, key=repr)
    assert QUERIES["op11_cross_tokenizer_alignment"](spark, fixtures.folder(spark, tmp_path / "e", [])).count() == 0


def test_general_interface_gives_places(spark):
    found = alignment.align(cases.table(spark, [(1, "the cat sat", "a"), (2, None, "a")]), A, B).orderBy("doc_id").collect()
    assert found[1]["ids_a"] == [] and found[1]["links"] == []
    row = found[0]
    assert [(x["place_a"], x["place_b"]) for x in row["links"]][-1] == (len(row["ids_a"]) - 1, len(row["ids_b"]) - 1)
    bound = len(alignment._pair(A, B).a.data) + len(alignment._pair(A, B).b.data)
    assert bound < 600_000
