"""Choosing, capping and numbering rows without moving them, against plain sorts."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ordinals, selection
from tallyloom.operators import mining as M
from tallyloom.operators import sampling as S


def digest(seed, row_id):
    text = str(seed) if row_id is None else f"{seed}:{row_id}"
    return hashlib.md5(text.encode()).hexdigest()


def halves(counts):
    return counts.select("g", F.ceil(F.col("rows") / 2).alias("quota"))


def test_chosen_rows_are_the_first_of_their_group(spark):
    # One group holds most rows, one is missing, one has a single row.
    group = F.when(F.col("id") < 6000, "big").when(F.col("id") < 6500, F.lit(None)).when(F.col("id") < 6501, "one").otherwise("small")
    df = spark.range(7000).select(group.alias("g"), F.col("id").cast("string").alias("id")).repartition(7)
    rows = [tuple(r) for r in df.collect()]
    got = {(r.g, r.id) for r in selection.with_chosen(df, "g", 42, ["id"], halves).where("chosen").collect()}
    want = set()
    for g in {g for g, _ in rows}:
        own = sorted((digest(42, i), i) for x, i in rows if x == g)
        want |= {(g, i) for _, i in own[: -(-len(own) // 2)]}
    assert got == want


@pytest.mark.parametrize("quota", [1, 2, 7, 333, 600, 900])
def test_missing_and_repeated_ids_fill_quotas_exactly(spark, quota):
    # Missing ids, ids shared by different rows, and equal rows, each a third of a group.
    row_id = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("same")).otherwise(F.col("id").cast("string"))
    value = F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(900).select(F.lit("g").alias("g"), row_id.alias("id"), value.alias("v"), F.array(F.lit(1)).alias("a")).repartition(5)
    marked = selection.with_chosen(df, "g", 7, ["id"], lambda c: c.select("g", F.lit(quota).alias("quota")))
    rows = [(r.id, r.v, r.chosen) for r in marked.collect()]
    assert len(rows) == 900 and sum(r[2] for r in rows) == quota
    assert Counter(r[:2] for r in rows) == Counter((r.id, r.v) for r in df.collect())
    # By digest of the id: nothing left out comes before anything chosen.
    assert max(digest(7, r[0]) for r in rows if r[2]) <= min((digest(7, r[0]) for r in rows if not r[2]), default="g")


def test_quotas_beyond_and_below_a_group(spark):
    df = spark.range(10).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("id"))
    for quota, want in ((0, 0), (10, 10), (99, 10)):
        marked = selection.with_chosen(df, "g", 1, ["id"], lambda c: c.select("g", F.lit(quota).alias("quota")))
        assert marked.where("chosen").count() == want and marked.count() == 10
    assert selection.with_chosen(df.limit(0), "g", 1, ["id"], halves).count() == 0


def test_cut_offs_are_refined_inside_one_bin(spark):
    # All keys share their first 36 bits.
    keys = spark.range(5000).select(F.lit("g").alias("g"), (F.lit(1 << 50) + F.col("id") * 3).alias("__key"))
    quotas = spark.createDataFrame([("g", 1234)], "g string, quota bigint")
    cuts, groups, ties = selection.cut_offs(keys, "g", quotas)
    assert (cuts.first()["cut"], groups, ties) == ((1 << 50) + 1233 * 3, 1, False)


def test_running_totals_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "_RANGE", 5)
    df = spark.range(1, 301).select("id", (F.col("id") % 7).alias("v"))
    got = {r.id: r.t for r in ordinals.running_total(df, "id", "v", "t").collect()}
    assert got == {i: sum(j % 7 for j in range(1, i)) for i in range(1, 301)}


def test_blocks_match_a_plain_sort(spark, monkeypatch):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "a").when(F.col("id") % 2 == 0, F.lit(None)).alias("g"), F.hash("id").alias("k"), "id")
    rows = [tuple(r) for r in df.collect()]
    want = {}
    for g in {r[0] for r in rows}:
        for place, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])):
            want[r[2]] = place // 64 + 1
    blocks = ordinals.with_block(df.repartition(6), [F.col("k"), F.col("id")], ["g"], 64)
    assert {r.id: r.block for r in blocks.collect()} == want
    # With more bounds than may be broadcast, rows are numbered themselves.
    monkeypatch.setattr(ordinals, "MAX_BROADCAST_ROWS", 10)
    blocks = ordinals.with_block(df.repartition(6), [F.col("k"), F.col("id")], ["g"], 64)
    assert {r.id: r.block for r in blocks.collect()} == want


@pytest.mark.parametrize("size", [1, 10])
def test_blocks_of_equal_rows_stay_within_their_size(spark, size):
    df = spark.range(205).select(F.lit("g").alias("g"), F.lit(1).alias("k")).repartition(4)
    blocks = Counter(r.block for r in ordinals.with_block(df, [F.col("k")], ["g"], size).collect())
    assert max(blocks.values()) == size and sum(blocks.values()) == 205 and len(blocks) == -(-205 // size)


@pytest.mark.parametrize("n", [3, 40, 100])
def test_cap_among_equal_rows(spark, n):
    df = spark.range(90).select(F.lit("r").alias("repo_url"), (F.col("id") % 3).alias("at")).repartition(4)
    got = [r.at for r in M.mining_cap(df, n, order=[F.col("at")]).collect()]
    assert sorted(got) == sorted([0] * 30 + [1] * 30 + [2] * 30)[:n]


def wide(spark):
    return spark.range(500).select(
        F.concat(F.lit("r"), F.col("id") % 3).alias("repo_name"), F.col("id").cast("string").alias("id"),
        F.lit(3).alias("metrics_cyclomatic_complexity"), F.lit(20).alias("metrics_n_ast_nodes"), F.repeat(F.lit("x"), 50).alias("wide"),
    )


@pytest.mark.parametrize("operator", ["sample", "split", "cap"])
def test_no_window_and_no_wide_column_in_a_shuffle(spark, operator):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = wide(spark)
        if operator == "sample":
            result = S.proportional_sample(df, 100)
        elif operator == "split":
            result = S.stratified_split(df, 0.2)
        else:
            result = M.mining_cap(df, 150, repo=["repo_name"], order=[F.col("id")])
        text = result._jdf.queryExecution().executedPlan().toString()
        assert result.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "wide" in text and "Window" not in text and "BroadcastHashJoin" in text
    # Nothing but the small tables is exchanged.
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
