"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import mining as M
from tallyloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# One query per operator family; the generation loop runs eagerly and is left out.
LAZY = [n for n in QUERIES if not n.startswith(("n9", "p15", "k", "a15", "a16"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["t3_next_token_topk", "w2_dedupe_keep_last", "j3_lookup_topk"])
def test_rank_limits_apply_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    partial = [m.start() for m in re.finditer("WindowGroupLimit .*Partial", text)]
    final = [m.start() for m in re.finditer("WindowGroupLimit .*Final", text)]
    # Plans print top down: the final limit, the shuffle, the limit inside each task.
    assert partial and final
    assert "Exchange hashpartitioning" in text[final[0] : partial[0]]


def test_counts_are_hash_aggregates_with_partial_step(spark):
    text = plan(QUERIES["a9_ngram_counts_n3"](spark, SF))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2


def test_padding_is_not_repeated_for_every_position(spark):
    text = plan(QUERIES["n1_extract_ngrams"](spark, SF))
    assert "regexp_extract_all" not in text[: text.index("Generate explode")]


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["f7_select_split"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in text
    text = plan(QUERIES["s2_scan_changes"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "props" not in text


def test_candidates_stay_where_they_are(spark):
    from tallyloom.operators import generation as G
    from tallyloom.operators.ngrams import NGramModel

    rows = [(i, [f"t{(i * j) % 23}" for j in range(30)]) for i in range(60)]
    train = spark.createDataFrame(rows, "row_ord bigint, code_tokens array<string>")
    model = NGramModel(3).fit(train)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with G.candidate_table(model, 10) as candidates:
            contexts = sorted(r.ctx for r in candidates.select("ctx").collect())[::3]
            asked = spark.createDataFrame([(c,) for c in contexts * 2 + [["no", "where"]]], "ctx array<string>")
            found = G.look_up(candidates, asked)
            text = plan(found)
            assert sorted(r.ctx for r in found.collect()) == contexts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in text and "Bucketed: true" in text
    # Of the join's two sides the first is the table: nothing stands between it and the join.
    streamed = text[text.index("ShuffledHashJoin") : text.index("FileScan")]
    assert "Exchange" not in streamed and "Sort" not in streamed
    # The catalog forgets the table.
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("candidates_")]


def test_nodes_are_shuffled_once(spark):
    from tallyloom.operators import trees
    from tallyloom.plans import standins as D

    texts = D.documents(spark, SF).select(F.col("doc_id").cast("string").alias("record_id"), "text")
    for nodes in (D.document_nodes(spark, SF, True), D.document_nodes(spark, SF, True).drop("is_leaf")):
        text = plan(trees.all_metrics(nodes, texts, with_tokens=True))
        # The texts' numbers are broadcast or shuffled once more, as Spark measures them.
        own = text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning")
        assert own - text.count("SortMergeJoin") == 1 and text.count("Join ") == 1


def test_chunk_keys_travel_without_records(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("repo"), "id", F.repeat(F.lit("x"), 50).alias("wide"))
    text = plan(M.chunk_number(df, ["repo"], [F.col("id")], 20))
    # Only the bounds are exchanged; records meet them where they are.
    exchanged = [text[m.start() : m.start() + 200] for m in re.finditer("Exchange hashpartitioning", text)]
    assert len(exchanged) == 1 and "collect_list(__place" in exchanged[0]
    assert "BroadcastHashJoin" in text


def test_a_split_and_a_range_of_rows_prune_the_dataset(spark):
    from tallyloom.plans.catalog import split_rows
    from tallyloom.plans import standins as D
    from tallyloom.session import scratch_path
    from tallyloom.sources import records as R
    from tallyloom.sources import sinks as K

    path = scratch_path(spark)
    rows = D.methods(spark, SF).withColumn("dataset_split", D.split_of(F.col("row_ord")))
    K.write_dataset(rows.repartition(1), path)
    text = plan(split_rows(R.read_dataset(spark, path)))
    assert re.search(r"PartitionFilters: \[[^\]]*dataset_split#\d+ = test", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(row_ord", text)
    assert "code_tokens" not in text
    # Rows lie in order, so row groups cover narrow ranges.
    test = spark.read.parquet(f"{path}/dataset_split=test").select("row_ord").collect()
    assert [r.row_ord for r in test] == sorted(r.row_ord for r in test)
