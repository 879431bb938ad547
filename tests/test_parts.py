"""Windows gathered part by part: the same answers as in one part, each part's files gone before the next."""

import os
import re

from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.operators import evaluation as E
from tallyloom.operators import generation as G
from tallyloom.operators import incremental as I
from tallyloom.operators import ngrams as N

SCHEMA = "row_ord bigint, code_tokens array<string>"
ODD = [None, "", "\0", "\1", "a", "b", "c", "<START>"]


def token_rows(spark, seed=3, n=50):
    rows = [(i, [ODD[(i * 7 + j * j * seed + j) % len(ODD)] for j in range(i % 23)]) for i in range(n)]
    return spark.createDataFrame([*rows, (None, ["a", None, "b"]), (3, None)], SCHEMA)


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def in_small_parts(monkeypatch):
    released = []
    monkeypatch.setattr(N, "PART_WINDOWS", 200)
    monkeypatch.setattr(session, "release", lambda spark, release=session.release: released.append(release(spark)))
    return released


def test_counts_of_parts_are_those_of_the_whole(spark, monkeypatch):
    df, columns = token_rows(spark), ["n", "ctx", "nxt", "c", "first_seen"]
    wanted = N.count_ngrams(N.extract_ngrams(df, 3, keep=["row_ord"]))
    asked = N.extract_ngrams(token_rows(spark, 5, 30), 3).select("n", "ctx")
    known = wanted.join(asked.distinct(), ["n", "ctx"], "left_semi")
    released = in_small_parts(monkeypatch)
    assert listed(N.NGramModel(3).fit(df).counts.select(columns)) == listed(wanted.select(columns))
    assert len(released) > 1
    few = N.NGramModel(3).fit(df, contexts=asked).counts.select(columns)
    monkeypatch.setattr(N, "MAX_BROADCAST_ROWS", 0)
    many = N.NGramModel(3).fit(df, contexts=asked).counts.select(columns)
    assert listed(few) == listed(many) == listed(known.select(columns))


def test_tasks_grow_with_the_windows(spark, monkeypatch):
    monkeypatch.setattr(N, "TASK_WINDOWS", 10)
    text = plan(N.packed_counts(token_rows(spark), 3, windows=171))
    assert re.search(r"hashpartitioning\(ctx#\d+, 18\)", text)


def test_the_grid_is_scored_in_parts(spark, monkeypatch):
    train, test = token_rows(spark), token_rows(spark, 5, 30)
    grid = [*E.CONFIGURATIONS[:2], E.Configuration(5, "laplace"), E.Configuration(1, "laplace")]
    wanted = E.score_grid(train, test, grid).collect()
    monkeypatch.setattr(E, "MAX_BROADCAST_ROWS", 0)
    released = in_small_parts(monkeypatch)
    got = E.score_grid(train, test, grid).collect()
    assert len(released) > 2
    rounded = lambda rows: [[f"{x:.9g}" if isinstance(x, float) else x for x in r] for r in rows]
    assert rounded(got) == rounded(wanted)


def test_few_contexts_go_to_the_candidates(spark, monkeypatch):
    model = N.NGramModel(3).fit(token_rows(spark))
    in_small_parts(monkeypatch)
    with G.candidate_table(model, 10) as candidates:
        contexts = candidates.select("ctx")
        assert listed(contexts) == listed(model.counts.select("ctx").distinct())
        found = G.look_up(candidates, contexts.limit(5), few=True)
        text = plan(found)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text[: text.index("BroadcastExchange")]
        assert found.count() == 5
        # A lookup reads flat columns and no context.
        assert "ctx" not in re.search(r"ReadSchema: struct<a:bigint[^\n]*", text)[0]
        folder = candidates.inputFiles()[0].removeprefix("file:").rpartition("/")[0]
        assert os.path.exists(folder)
    assert not os.path.exists(folder)


def test_forgotten_counts_are_removed(spark, monkeypatch):
    df = token_rows(spark)
    monkeypatch.setattr(N, "PART_WINDOWS", 200)
    one, two = (I.train_batch(N.NGramModel(3), df.where(F.col("row_ord") % 2 == i)) for i in (0, 1))
    folders = [one.path.removeprefix("file:"), two.path.removeprefix("file:")]
    assert all(map(os.path.exists, folders))
    model = I.merge(one, two)
    assert not any(map(os.path.exists, folders))
    whole = N.NGramModel(3).fit(df.where("row_ord is not null"))
    columns = ["n", "ctx", "nxt", "c", "first_seen"]
    assert listed(model.counts.select(columns)) == listed(whole.counts.select(columns))
    model.forget()
