"""Content-defined chunks against plain calls of the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import chunked_bpe
from tallyloom.llm.queries import QUERIES

from . import cases, fixtures

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    "a", "b", " ", "\n", "  ", "\t", "é", "é", " ́", "Σ", "ς", "<|endoftext|>", "<|STARTOFTEXT|>", "日本", "'s", "'S",
    "1", "23", "!?", " ", "　", "İ", "ﬁ", "<|endof", "text|>", "\x00", "\x85", "word", "the",
]


@pytest.fixture(scope="module")
def huggingface():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def small(bits, encode=None):
    encoder = chunked_bpe.ChunkEncoder(encode or chunked_bpe._library(PATH).plain, bits, store_chars=3000)
    encoder._words._limit = 200
    return encoder


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=120).map("".join), max_size=5), st.integers(1, 5))
def test_any_text_encodes_and_decodes_like_the_library(texts, bits):
    library, plain = chunked_bpe._library(PATH), chunked_bpe._library(PATH)._tokenizer
    for text, ids in zip(texts, small(bits)(texts)):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert library.decode(ids) == plain.decode(want, skip_special_tokens=False)


def test_long_texts_share_chunks(huggingface):
    random = np.random.default_rng(5)
    words = ["w" + "".join(random.choice(list("abcde"), 5)) for _ in range(20_000)]
    shared = " ".join(words[:15_000])
    texts = [shared, "other start. " + shared, " ".join(words[15_000:]) + "\n" + shared + " other end"]
    encoder = small(9)
    assert [x.tolist() for x in encoder(texts)] == [huggingface.encode(t, add_special_tokens=False).ids for t in texts]
    # The passage's chunks are met three times and encoded once.
    assert encoder.encoded < encoder.met / 2 and encoder.met > 300


def test_texts_without_white_space(huggingface):
    texts = ["x" * 50_000, "日本語" * 20_000, "ab1!" * 5000 + " end", "start " + "q" * 3000]
    assert [x.tolist() for x in small(6)(texts)] == [huggingface.encode(t, add_special_tokens=False).ids for t in texts]


def test_windows_grow_until_they_agree():
    """A code in which a word's id depends on what stands before it: windows must say so and grow."""
    numbers = {}

    def encode(texts):
        out = []
        for text in texts:
            words = text.split()
            ids = [numbers.setdefault(w, len(numbers)) for w in words]
            if len(words) > 1 and words[0] == "odd":
                ids[0] = -1
            out.append(ids)
        return out

    encoder = small(3, encode)
    words = [("odd", "even", f"word{i}")[i % 3] for i in range(60)]
    assert len(encoder([" ".join(words)])[0]) == 60
    assert encoder.widened > 0


def test_cuts_depend_on_content_and_keep_characters_whole():
    text = " ".join(f"münze{i}" for i in range(4000)).encode()
    ends, later = chunked_bpe.cut(text), chunked_bpe.cut("日本 ".encode() + text)
    assert len(ends) > 20
    shift = len("日本 ".encode())
    assert {e + shift for e in ends if e > 64} <= set(later)
    for a, b in zip([0, *ends], ends):
        text[a:b].decode()
    assert chunked_bpe.cut(b"") == []


def test_query_on_awkward_rows(spark, tmp_path, huggingface):
    rows = [*cases.TEXTS, (20, "a<|endoftext|>b <|startoftext|>", "a"), (21, "日本語" * 5000, "b"), (22, cases.SENTENCE * 40, "a")]
    found = QUERIES["op13_chunked_bpe"](spark, fixtures.folder(spark, tmp_path / "t", rows))
    want = []
    for doc_id, text, _ in rows:
        ids = huggingface.encode(text or "", add_special_tokens=False).ids
        decoded = huggingface.decode(ids, skip_special_tokens=False)
        want.append(
            (
                doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert cases.plain(found) == sorted(want, key=repr)
    assert QUERIES["op13_chunked_bpe"](spark, fixtures.folder(spark, tmp_path / "e", [])).count() == 0


def test_tables_of_ids_decode(spark, huggingface):
    docs = cases.table(spark)
    decoded = chunked_bpe.decode(chunked_bpe.encode(docs, PATH), PATH).collect()
    want = [
        (repr(i), huggingface.decode(huggingface.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False))
        for i, t, _ in cases.TEXTS
    ]
    assert sorted((repr(r["doc_id"]), r["decoded"]) for r in decoded) == sorted(want)
