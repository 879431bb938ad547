from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import cleaning as C
from tallyloom.operators import mining as M
from tallyloom.operators import ordinals
from tallyloom.operators import sampling as S
from tallyloom.operators.dedupe import dedupe_keep_last, duplicate_report


def test_search_repos(rows):
    lo, hi = date(2024, 1, 1), date(2024, 12, 31)
    df = rows(
        [("a", "Java", 5000, False, lo), ("b", "java", 5001, False, lo), ("c", "java", 9000, True, lo),
         ("d", "java", 7000, False, hi), ("e", "java", 7000, False, date(2025, 1, 1)), ("f", "go", 8000, False, lo)],
        "clone_url string, language string, stars bigint, fork boolean, pushed_at date",
    )
    assert [r.clone_url for r in M.search_repos(df, lo, hi).collect()] == ["d", "b"]


def test_scan_changes(rows):
    t = datetime(2024, 1, 1)
    df = rows(
        [("u", "c1", t, "A.java", "x"), ("u", "c1", t, "README.md", "y"), ("u", "c1", t, "B.java", None),
         ("u", "c2", t, "x.py", "z"), ("u", "c3", datetime(2023, 1, 1), "C.java", "w")],
        "repo_url string, commit_sha string, committed_ts timestamp, new_path string, source_code string",
    )
    got = M.scan_changes(df, t, datetime(2024, 2, 1))
    assert sorted(r.new_path for r in got.collect()) == ["A.java", "B.java", "README.md"]
    assert sorted(r.new_path for r in M.has_source(got).collect()) == ["A.java", "README.md"]
    strict = M.scan_changes(df, t, datetime(2024, 2, 1), strict_ext=True)
    assert sorted(r.new_path for r in strict.collect()) == ["A.java", "B.java"]


def test_line_and_length_filters(rows):
    lines = rows([(0, 3), (5, 4), (5, 5)], "method_start_line bigint, method_end_line bigint")
    assert [tuple(r) for r in lines.where(C.valid_line_span()).collect()] == [(5, 5)]
    sizes = rows([(n,) for n in (2, 3, 100, 101)], "metrics_nloc bigint")
    assert [r[0] for r in sizes.where(C.nloc_between()).collect()] == [3, 100]
    quality = rows(
        [(c, n) for c in (1, 2, 15, 16) for n in (10, 11)],
        "metrics_cyclomatic_complexity bigint, metrics_n_ast_nodes bigint",
    )
    assert sorted(tuple(r) for r in C.quality_filter(quality).collect()) == [(2, 11), (15, 11)]


def test_duplicates(rows):
    df = rows(
        [("r", "p", "s", "a1", "1"), ("r", "p", "s", "b2", "2"), ("r", "p", "s", None, "3"), ("r", None, "s", "z", "4"),
         ("r", None, "s", "y", "5"), ("q", "p", "s", "c", "6")],
        "repo_name string, file_path string, method_signature string, repo_commit_sha string, id string",
    )
    assert sorted(r.id for r in duplicate_report(df).collect()) == ["1", "2", "3", "4", "5"]
    assert sorted(r.id for r in dedupe_keep_last(df).collect()) == ["3", "4", "6"]


def test_flatten_and_bad_rows(rows):
    df = rows([((1, (2,)), [3], "x"), (None, None, None)], "a struct<b:bigint,c:struct<d:bigint>>, e array<bigint>, f string")
    flat = C.flatten_one_level(df)
    assert flat.columns == ["a_b", "a_c", "e", "f"]
    good, bad = C.isolate_bad_rows(flat, ["f"])
    assert good.count() == 1 and [r.bad_reason for r in bad.collect()] == ["missing f"]


def test_metric_shapes(rows):
    ast = "ast_metrics struct<n_ast_nodes:bigint,ast_depth:bigint,n_identifiers:bigint,vocab_size:bigint,code_tokens:array<string>,token_counts:bigint>"
    tree = (9, 3, 2, 2, ["a", "b"], 7)
    nested = rows([((1, 2, 3), tree, 4)], f"text_metrics struct<n_whitespaces:bigint,n_words:bigint,nloc:bigint>, {ast}, cyclomatic_complexity bigint")
    got = M.coalesce_metric_shape(nested).first()
    assert (got.n_whitespaces, got.n_words, got.nloc, got.token_counts) == (1, 2, 3, 7)
    flat = rows([(tree, 4, 5)], f"{ast}, cyclomatic_complexity bigint, nloc bigint")
    got = M.coalesce_metric_shape(flat).first()
    assert (got.n_whitespaces, got.nloc, got.token_counts, got.code_tokens) == (0, 5, 2, ["a", "b"])


def test_chunks_follow_ordinals(spark):
    df = spark.range(7001).select(F.lit("r").alias("repo"), "id").union(spark.range(3).select(F.lit("q"), "id"))
    chunks = M.chunk_number(df, ["repo"], [F.col("id")])
    got = {(r.repo, r.id): r.chunk for r in chunks.collect()}
    assert got["r", 0] == 1 and got["r", 4999] == 1 and got["r", 5000] == 2 and got["q", 2] == 1


@pytest.mark.parametrize("n", [0, 1, 5, 700, 999, 5000])
def test_mining_cap_matches_a_plain_sort(spark, n):
    # One repository holds a third of the rows.
    repo = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11)
    df = spark.range(1000).select(repo.alias("repo_url"), F.hash("id").alias("at"), "id").repartition(5)
    want = sorted((r.repo_url, r.at, r.id) for r in df.collect())[:n]
    got = M.mining_cap(df, n, order=[F.col("at"), F.col("id")])
    assert sorted((r.repo_url, r.at, r.id) for r in got.collect()) == want


def test_ordinals_with_ties_are_a_permutation(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.lit(1).alias("k"))
    numbered = ordinals.with_ordinal(df, [F.col("k")], ["g"]).collect()
    for g in (0, 1):
        assert sorted(r.ordinal for r in numbered if r.g == g) == list(range(1, 251))


def sizes(df, key="repo_name"):
    return {r[0]: r[1] for r in df.groupBy(key).count().collect()}


def repos(spark, **counts):
    frames = [spark.range(n).select(F.lit(r).alias("repo_name"), F.concat(F.lit(r), "id").alias("id")) for r, n in counts.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result


def test_proportional_sample(spark):
    df = repos(spark, a=60, b=30, c=10)
    assert sizes(S.proportional_sample(df, 50)) == {"a": 30, "b": 15, "c": 5}
    assert S.proportional_sample(df, 50).select("id").distinct().count() == 50
    small = repos(spark, a=6, b=4)
    assert S.proportional_sample(small, 50).count() == 0
    assert S.proportional_sample(small, 50, on_shortfall="all").count() == 10


def test_sample_counts_but_never_draws_missing_repos(spark):
    df = repos(spark, a=50).union(spark.range(50).select(F.lit(None).cast("string"), F.col("id").cast("string")))
    assert sizes(S.proportional_sample(df, 50)) == {"a": 25}


def test_stratified_split(spark):
    split = S.stratified_split(repos(spark, a=30, b=15, c=5), 0.2)
    assert sizes(split.where("dataset_split = 'test'")) == {"a": 6, "b": 3, "c": 1}
    alone = S.stratified_split(repos(spark, a=9, b=1), 0.2)
    assert sizes(alone.where("dataset_split = 'test'")) == {"a": 2}
    assert alone.count() == 10


def test_sample_from_large_repos(spark):
    df = repos(spark, a=100, b=50).withColumns(
        {"metrics_cyclomatic_complexity": F.lit(3), "metrics_n_ast_nodes": F.lit(20)}
    )
    result = S.sample_from_large_repos(df, 40, 10).collect()
    assert sorted(r.row_ord for r in result) == list(range(49))
    n_test = sum(r.dataset_split == "test" for r in result)
    assert n_test == 10
    assert all((r.row_ord >= 39) == (r.dataset_split == "test") for r in result)


def test_step_report(rows):
    schema = "repo_name string, file_path string, method_signature string, method_name string, method_start_line bigint, method_end_line bigint, metrics_nloc bigint, metrics_cyclomatic_complexity bigint, repo_license string"
    ok = ("r", "p", "s", "ab", 1, 5, 5, 2, None)
    df = rows([ok, ok, ok[:3] + ("a",) + ok[4:], ok[:4] + (0,) + ok[5:], ok[:6] + (1,) + ok[7:], ok[:7] + (0, None)], schema)
    assert [r.rows for r in C.step_report(df).orderBy("step_no").collect()] == [6, 5, 4, 3, 2, 1]


def test_licenses(rows):
    repos = rows([("https://example.org/o/r.git",), ("https://example.org/o/s/",), ("x",)], "repo_url string")
    known = rows([("o/r", "mit"), ("o/r", "mit"), ("o/s", "gpl")], "owner_repo string, license_key string")
    got = {r.repo_url: r.license_key for r in M.attach_license(repos, known).collect()}
    assert got == {"https://example.org/o/r.git": "mit", "https://example.org/o/s/": "gpl", "x": None}


def test_mining_report(rows):
    df = rows([("a",)] * 5 + [("b",)], "repo_url string")
    got = {r.repo_url: (r.methods, r.chunks, r.is_total) for r in M.mining_report(df, chunk_size=2).collect()}
    assert got == {"a": (5, 3, 0), "b": (1, 1, 0), None: (6, None, 1)}
