"""Windows that move once: the same answers as models that are fitted, for any token, and plans with one shuffle."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import evaluation as E
from tallyloom.operators import ngrams as N
from tallyloom.operators import trees
from tallyloom.sources import records as R
from tallyloom.sources import sinks as K

SCHEMA = "row_ord bigint, code_tokens array<string>"
ODD = [None, "", "\0", "\1", "\0n", "\0a", "\0b", "a", "a\1b", "<START>", "<END>"]


def odd_rows(spark, seed, n):
    rows = [(i % (n - 2), [ODD[(i * 7 + j * j * seed + j) % len(ODD)] for j in range(i % 23)]) for i in range(n)]
    return spark.createDataFrame([*rows, (None, ["a", None, "b"]), (3, None)], SCHEMA)


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange \w+\(?([^,)#]*)", text)


@pytest.mark.parametrize("n", [2, 3, 5])
def test_packed_contexts_are_those_of_the_windows(spark, n):
    df = odd_rows(spark, 3, 40)
    plain = N.count_ngrams(N.extract_ngrams(df, n, keep=["row_ord"]))
    key = lambda r: (r.n, tuple(r.ctx), r.nxt, r.c, r.first_seen)
    assert sorted(map(key, N.ngram_counts(df, n).collect()), key=repr) == sorted(map(key, plain.collect()), key=repr)


@pytest.mark.parametrize("n", [3, 5])
def test_asked_model_equals_fitted_one(spark, n):
    train, test = odd_rows(spark, 3, 60), odd_rows(spark, 5, 30)
    asked, fitted = E.fit_for(N.NGramModel(n), train, test), N.NGramModel(n).fit(train)
    assert E.topk_accuracy(asked, test).first() == E.topk_accuracy(fitted, test).first()
    assert E.topk_accuracy(asked, test, 9, max_positions=8).first() == E.topk_accuracy(fitted, test, 9, max_positions=8).first()
    a, b = E.perplexity(asked, test).first(), E.perplexity(fitted, test).first()
    assert a.positions == b.positions and a.perplexity == pytest.approx(b.perplexity)
    pairs = N.extract_ngrams(test, n).select("n", "ctx", "nxt").distinct()
    wanted = N.lookup_counts(pairs, fitted.counts, fitted.totals).select("ctx", "nxt", "c", "ct")
    got = asked.look_up(test, context=True).select("ctx", "nxt", "c", "ct")
    assert sorted(got.collect(), key=repr) == sorted(wanted.collect(), key=repr)
    contexts = N.extract_ngrams(test, n).select("n", "ctx").distinct()
    best = N.lookup_topk(contexts, N.candidate_lists(fitted.counts)).select("ctx", F.col("candidates.nxt").alias("best"))
    listed = asked.look_up(test, context=True, contexts_only=True).where("ct > 0").select("ctx", "best")
    assert sorted(listed.collect(), key=repr) == sorted(best.collect(), key=repr)


def test_windows_move_once(spark):
    df = odd_rows(spark, 3, 40)
    assert len(exchanges(N.next_token_topk(N.packed_counts(df, 3)))) == 1
    assert len(exchanges(N.context_totals(N.packed_counts(df, 5)))) == 1


def test_a_head_moves_only_its_own_windows(spark):
    train, test = odd_rows(spark, 3, 60), odd_rows(spark, 5, 30)
    found = E.fit_for(N.NGramModel(5), train, test).look_up(test.where("row_ord < 2"))
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()


def test_a_head_of_long_rows_asks_only_about_positions_within(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_BROADCAST_ROWS", 50)
    train = odd_rows(spark, 3, 60)
    test = spark.createDataFrame([(i, [ODD[(i + j) % len(ODD)] for j in range(40)]) for i in range(9)], SCHEMA)
    asked, fitted = E.fit_for(N.NGramModel(5), train, test), N.NGramModel(5).fit(train)
    found = E.topk_accuracy(asked, test, 5, max_positions=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Windows are counted in the tasks before they move, so nothing is gathered by context alone.
    assert "LeftSemi" in plan and "REPARTITION_BY_COL" not in plan
    assert found.first() == E.topk_accuracy(fitted, test, 5, max_positions=10).first() and found.first().total_predictions > 0
    # With longer contexts none of the ten positions counts.
    longer = E.fit_for(N.NGramModel(11), train, test)
    assert E.topk_accuracy(longer, test, 5, max_positions=10).first().total_predictions == 0


def test_nodes_move_before_they_are_gathered(spark):
    nodes = spark.createDataFrame(
        [("r", 0, None, 0, 1, "program", "a b", False), ("r", 1, 0, 0, 2, "identifier", "a", True)],
        "record_id string, node_id bigint, parent_id bigint, sibling_ord int, depth int, node_type string, text string, is_leaf boolean",
    )
    text = trees.leaf_tokens(nodes)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Aggregate" not in text[text.index("Exchange") :]


def test_csv_files_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "CSV_ROWS", 10)
    df = spark.range(95).coalesce(1).select(F.col("id").alias("row_ord"), F.lit("x\n\"y\"").alias("code"), F.array(F.lit("t")).alias("code_tokens"))
    K.write_dataset(df, str(tmp_path / "d"), "csv")
    assert len(glob.glob(str(tmp_path / "d" / "part-*"))) == 10
    back = R.read_dataset(spark, str(tmp_path / "d"), "csv")
    assert sorted(int(r.row_ord) for r in back.collect()) == list(range(95))
    assert {(r.code, tuple(r.code_tokens)) for r in back.collect()} == {("x\n\"y\"", ("t",))}
