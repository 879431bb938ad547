"""What a model's counts and windows need to move: once by context, and only where they are asked for."""

import re

from pyspark.sql import functions as F

from tallyloom.operators import generation as G
from tallyloom.operators import incremental as I
from tallyloom.operators import ngrams as N

SCHEMA = "row_ord bigint, code_tokens array<string>"


def token_rows(spark, seed=3):
    rows = [(i, [f"t{(i * j + seed) % 23}" if j % 9 else None for j in range(i % 31)]) for i in range(60)]
    return spark.createDataFrame([*rows, (None, ["t1", "t2"]), (3, None)], SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def listed(df):
    return sorted(((r.ctx, [(c.token, c.prob) for c in r.candidates]) for r in df.collect()), key=repr)


def test_counts_move_once_to_the_candidates(spark):
    model = N.NGramModel(3).fit(token_rows(spark))
    laid_out = model.candidates(5, model.counts.repartition(7, "ctx")).select("ctx", "candidates").repartition(7, "ctx")
    assert plan(laid_out).count("Exchange ") == 1 and plan(model.candidates()).count("Exchange ") == 1
    total = N.candidate_lists(model.counts).join(model.totals, ["n", "ctx"])
    p = lambda x: F.struct(x["nxt"].alias("token"), model.probability(x["c"], F.col("ct")).alias("prob"))
    wanted = listed(total.select("ctx", F.transform("candidates", p).alias("candidates")))
    assert listed(laid_out) == listed(model.candidates()) == wanted


def test_predictions_rank_only_contexts_that_are_asked(spark):
    model = N.NGramModel(3).fit(token_rows(spark))
    prompts = spark.createDataFrame(
        [(1, ["t3", "t4"]), (1, ["t3", "t4"]), (None, ["t5"]), (2, []), (3, ["x", None]), (4, None), (5, ["t3", None])],
        "row_ord bigint, context array<string>",
    )
    found = model.predict(prompts)
    assert "LeftSemi" in plan(found)
    fitted = prompts.withColumns({"n": F.lit(3), "ctx": N.fit_context(F.col("context"), 3)})
    wanted = N.lookup_topk(fitted, model.candidates(), "left").select("row_ord", "context", "candidates")
    rows = sorted(((r.row_ord, r.context, r.predictions) for r in found.collect()), key=repr)
    assert rows == sorted(((r.row_ord, r.context, r.candidates or []) for r in wanted.collect()), key=repr)


def test_predictions_are_made_once(spark, monkeypatch):
    model = N.NGramModel(3).fit(token_rows(spark))
    rows = G.prediction_rows(model, token_rows(spark, 5).where("row_ord < 9"), max_length=2)
    assert not re.search("Window|first_seen", plan(rows))


def test_contexts_travel_as_96_bits(spark):
    fingerprints = N.fingerprints(token_rows(spark), [3, 5])
    assert [fingerprints.schema[c].dataType.simpleString() for c in ("a", "b")] == ["bigint", "int"]


def test_a_batch_is_written_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(I, "stored", lambda df, stored=I.stored: kept.append(df.columns) or stored(df))
    batch = I.train_batch(N.NGramModel(3), token_rows(spark))
    try:
        # The counts themselves are only in the bucketed table.
        assert kept == [["token"], ["sketch"]]
        got = batch.counts.select("n", "ctx", "nxt", "c", "first_seen").collect()
        wanted = N.count_ngrams(N.extract_ngrams(token_rows(spark), 3, keep=["row_ord"])).collect()
        assert sorted(got, key=repr) == sorted(wanted, key=repr)
    finally:
        batch.forget()


def test_an_empty_batch_is_a_model(spark):
    batch = I.train_batch(N.NGramModel(3), token_rows(spark).limit(0))
    try:
        assert batch.counts.count() == 0
    finally:
        batch.forget()
