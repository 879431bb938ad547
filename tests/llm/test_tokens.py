"""Token files and byte-pair encoding, held to the public libraries and to a plain merge loop."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import bpe, token_files
from tallyloom.session import scratch_path

from . import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "   ", "a  b", "a   b", "a \n b", "\n\n x", "x \n", "x\n ", "a\n \nb", "a \n\n b", " lead", "trail ",
    "aaaa" * 300, "日本語" * 100 + " x", "don't you'll 'S\t\tfoo  bar  ", "123 456\r\n\r\n 7", "\x1c \x1f a\x85b\xa0c",
    "<|endoftext|> hi", "a<|endoftext|>b", "a <|endoftext|> <|endoftext|>, b.<|endoftext|>!", "x\n<|endoftext|>\ny  <|endoftext|> z", "😀😀 🎉‍", "　　 a", "é" * 500, "ab" * 400, "\x00 \x00",
]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def huggingface():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]


def test_odd_texts_encode_like_the_libraries(tiktoken_encoding, huggingface):
    assert split(*bpe._encoder(RANKS, public_tokenizers.PATTERN)(ODD)) == [tiktoken_encoding.encode_ordinary(t) for t in ODD]
    assert split(*token_files._encoder(JSON)(ODD)) == [huggingface.encode(t, add_special_tokens=False).ids for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab e\n\t  éЖ日'sth.,1!"), max_size=40), max_size=4))
def test_any_text_encodes_like_the_libraries(texts):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    ids, ends = bpe._encoder(RANKS, public_tokenizers.PATTERN)(texts)
    assert (split(ids, ends) if texts else []) == [encoding.encode_ordinary(t) for t in texts]
    assert bpe._pairs(RANKS, public_tokenizers.PATTERN).decode(ids, ends) == [t.encode() for t in texts]


def one_at_a_time(ranks, word):
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_long_words_contract_like_one_pair_at_a_time():
    pairs = bpe.BytePairs(RANKS, public_tokenizers.PATTERN, query_rows=3000)
    random = np.random.default_rng(3)
    words = [bytes(random.choice(list(b"theanioabr"), int(n))) for n in (49, 60, 150, 700)] + [b"a" * 333, b"the" * 99]
    assert pairs._encode_words(words) == [one_at_a_time(pairs._ranks, w) for w in words]


def test_words_of_megabytes_are_joined_from_pieces(tiktoken_encoding):
    pairs = bpe.BytePairs(RANKS, public_tokenizers.PATTERN)
    random = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    texts = [
        "".join(random.choice(letters, 200_000)), "the" * 20_000, "a" * 20_001, "=" * 30_011, "ab" * 6_007 + "Б" * 5_003,
        "日本語文章" * 4_000, "".join(random.choice(list("aab"), 30_000)), "x" * 5_000_000,
    ]
    assert pairs.encode(texts) == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    ids = np.array(pairs.encode(texts[-1:])[0], np.int32)
    assert pairs.decode(ids, np.array([len(ids)])) == [texts[-1].encode()]


def test_cache_may_be_emptied_at_any_time(huggingface):
    from tallyloom.llm.pretokens import UnitEncoder

    encoder = UnitEncoder(lambda units: [huggingface.encode(u, add_special_tokens=False).ids for u in units], lambda t: [t], limit=2)
    texts = ["one two three", "two three four", cases.SENTENCE]
    for _ in range(2):
        for text in texts:
            assert encoder([text])[0].tolist() == huggingface.encode(text, add_special_tokens=False).ids


def test_bpe_digests(spark, tiktoken_encoding):
    found = cases.plain(bpe.digests(cases.table(spark), RANKS, public_tokenizers.PATTERN))
    want = []
    for doc_id, text, _ in cases.TEXTS:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        want.append(
            (
                doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert found == sorted(want, key=repr)
    assert bpe.digests(cases.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_tables_decode_to_the_texts(spark):
    docs = cases.table(spark)
    tokens = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(tokens, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in decoded) == sorted(
        (repr(i), (t or "").encode()) for i, t, _ in cases.TEXTS
    )


def test_token_files(spark, huggingface):
    rows = [r for r in cases.TEXTS if r[0] not in (1, 14, None)] + [(None, "first of all", "a")]
    path = scratch_path(spark)
    token_files.write_tokens(cases.table(spark, rows[::-1]), path, JSON)
    found = cases.plain(token_files.digests(token_files.read_tokens(spark, path)))
    want, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = huggingface.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == sorted(want, key=repr)


def test_token_files_repeat_rows_and_may_be_empty(spark):
    path = scratch_path(spark)
    token_files.write_tokens(cases.table(spark), path, JSON)
    rows = token_files.document_starts(token_files.read_tokens(spark, path)).orderBy("start").collect()
    assert len(rows) == len(cases.TEXTS)
    assert [r["start"] for r in rows] == [sum(len(x["ids"]) for x in rows[:i]) for i in range(len(rows))]
    assert [r["doc_id"] or -1 for r in rows] == sorted(r["doc_id"] or -1 for r in rows)
    path = scratch_path(spark)
    token_files.write_tokens(cases.empty(spark), path, JSON)
    assert token_files.digests(token_files.read_tokens(spark, path)).count() == 0


def test_orc_files_carry_bloom_filters_and_many_row_groups(spark):
    path = scratch_path(spark)
    token_files.write_tokens(cases.table(spark, [(i, f"text {i}", "a") for i in range(3000)]), path, JSON)
    tokens = token_files.read_tokens(spark, path)
    assert tokens.where("doc_id = 1234").count() == 1
    plan = tokens.where("doc_id = 1234")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1234)]" in plan
    import pyarrow.fs as fs
    from pyarrow import orc

    local, root = fs.FileSystem.from_uri(path)
    stripes = [orc.ORCFile(local.open_input_file(f.path)) for f in local.get_file_info(fs.FileSelector(root)) if f.path.endswith(".orc")]
    assert sum(f.nrows for f in stripes) == 3000
    assert all(f.compression.upper() == "ZSTD" and f.row_index_stride == 1000 for f in stripes)
