"""The pipeline against a plain program, and every query with an SQL form against DuckDB."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tallyloom.llm import bpe, mixing, oracles, quality, queries

from . import cases
from .test_near import jaccard_rows
from .test_rows import base_figures, expected_lines, targets, words_of

SF = "/root/testdata/sf0.001"


def python_pattern(pattern):
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", pattern).replace(r"\z", r"\Z")


def line_fails(line):
    count = lambda p: len(re.findall(python_pattern(p), line))
    words = len(words_of(line))
    letter = r"[^\W_]"
    phrase = f"(?i)(?<!{letter})(?:{quality.FURNITURE.removeprefix('(?i)')})(?!{letter})"
    furniture = sum(len(words_of(m[0])) for m in re.finditer(phrase, line))
    return words > 0 and (
        not count(quality.SENTENCE_END) or count(quality.SHOUT) * 2 > words
        or (count(quality.SEPARATOR) >= 2 and count(quality.SEPARATOR) * 3 >= words)
        or (furniture > 0 and furniture * 10 >= words * 3) or count(quality.SYMBOL_WORD) * 10 >= words * 3
    )


def plain_pipeline(rows):
    """rows: (doc_id, text, source) -> (doc_id, n_tokens, ids digest, text digest) of every copy."""
    kept = []
    for doc_id, text, source in rows:
        good = [x for x in (text or "").split("\n") if not line_fails(x)]
        n = len(words_of(text))
        if not base_figures(text)[5] and (n - len(words_of("\n".join(good)))) * 100 <= n * quality.MAX_LOST_PERCENT:
            kept.append((doc_id, "\n".join(good), source))
    holders = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for doc_id, text, _ in kept:
        for line in text.split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(doc_id)
    lined = []
    for doc_id, text, source in kept:
        stay = [x for x in text.split("\n") if len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        lined.append((doc_id, "\n".join(stay), source))
    first = {r[0] for r in jaccard_rows([(d, t) for d, t, _ in lined]) if r[4]}
    single = [r for r in lined if r[0] in first]
    sizes = Counter()
    for _, text, source in single:
        sizes[source] += len(words_of(text))
    quota = {s: math.floor(t + 1e-6) for s, t in targets(dict(sizes)).items()}
    draw = lambda d: int(hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest()[:8], 16)
    out, start = [], Counter()
    import tiktoken

    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
    )
    for doc_id, text, source in sorted(single, key=lambda r: (draw(r[0]), r[0])):
        size = len(words_of(text))
        if not size:
            continue
        taken = sum(min(max(quota[source] - k * sizes[source] - start[source], 0), size) for k in range(3))
        start[source] += size
        ids = encoding.encode_ordinary(text)
        row = (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        out += [row] * math.floor(taken / size + 0.5)
    return sorted(out, key=repr)


def test_pipeline_matches_a_plain_program(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    assert cases.plain(corpus_pipeline.run(spark, SF)) == plain_pipeline(rows)


def test_stages_keep_columns_and_take_awkward_tables(spark):
    for docs in (cases.table(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, SF)
            assert set(docs.columns) | {"copy", "position"} >= set(columns), name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_match_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(oracles.ORACLES[name])
    columns = [c[0] for c in want.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert cases.plain(found.select(*columns)) == sorted(want.fetchall(), key=repr)


def test_line_dedup_query_matches_a_plain_program(spark):
    rows = [(r["doc_id"], r["text"], None) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert cases.plain(queries.op2_line_dedup(spark, SF)) == expected_lines(rows)
