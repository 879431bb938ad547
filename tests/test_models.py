"""Models against hand-computed values and a plain-Python count of everything."""

import bisect
import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import evaluation as E
from tallyloom.operators import generation as G
from tallyloom.operators import ngrams as N

SCHEMA = "row_ord bigint, code_tokens array<string>"
WORDS = ["a", "b", "c", "d", "(", ")", ";", "}", "=", "x y"]


def table(spark, sequences):
    return spark.createDataFrame(list(enumerate(sequences)), SCHEMA)


def corpus(seed, rows, longest=60):
    rng = random.Random(seed)
    weights = [8, 6, 4, 3, 2, 2, 1, 1, 1, 1]
    return [rng.choices(WORDS, weights, k=rng.randint(0, longest)) for _ in range(rows)]


class Plain:
    """The same model as nested dictionaries."""

    def __init__(self, sequences, n, smoothing="laplace", k=1.0):
        self.n, self.smoothing, self.k = n, smoothing, k
        self.next, vocabulary = defaultdict(Counter), set()
        for tokens in sequences:
            padded = self.padded(tokens)
            vocabulary.update(padded)
            for i in range(n - 1, len(padded)):
                self.next[tuple(padded[i - n + 1 : i])][padded[i]] += 1
        self.v = len(vocabulary)

    def padded(self, tokens):
        return [N.START] * (self.n - 1) + list(tokens) + [N.END]

    def p(self, ctx, token):
        seen = self.next.get(ctx, Counter())
        c, ct = seen[token], sum(seen.values())
        if self.smoothing == "none":
            return c / ct if ct else 0.0
        k = 1.0 if self.smoothing == "laplace" else self.k
        return (c + k) / (ct + k * self.v)

    def top(self, context, size=5):
        width = self.n - 1
        fitted = ([N.START] * width + list(context))[-width:] if width else []
        seen = self.next.get(tuple(fitted), {})
        ranked = sorted(seen, key=lambda t: -seen[t])
        return [(t, self.p(tuple(fitted), t)) for t in ranked[:size]]

    def perplexity(self, rows):
        logs = []
        for tokens in rows:
            padded = self.padded(tokens)
            for i in range(self.n - 1, len(padded)):
                p = self.p(tuple(padded[i - self.n + 1 : i]), padded[i])
                logs.append(math.log(p if p > 0 else 1e-10))
        return math.exp(-sum(logs) / len(logs)), len(logs)

    def accuracy(self, rows, positions=None):
        """Hits among the first 1, 3 and 5, and positions with a known context, by listing every place."""
        places = []
        for padded in map(self.padded, rows):
            asked = padded[self.n - 1 : positions]
            lists = [[t for t, _ in self.top(padded[i : i + self.n - 1])] for i in range(len(asked))]
            places += [known.index(t) if t in known else 9 for t, known in zip(asked, lists) if known]
        return (*[sum(p < k for p in places) for k in (1, 3, 5)], len(places))

    def offered(self, context):
        return next((found for i in range(len(context)) if (found := self.top(context[i:]))), [])

    def complete(self, context, draw, max_length, made=()):
        choices = self.offered((list(context) + list(made))[-max(self.n - 1, 1) :] if made else list(context))
        sums = list(itertools.accumulate((p for _, p in choices), initial=0.0))[1:]
        if len(made) == max_length or not choices or not sums[-1]:
            return list(made)
        token = choices[min(bisect.bisect_right(sums, draw(len(made)) * sums[-1]), len(choices) - 1)][0]
        if token in (N.END, "}", ";"):
            return [*made, token] if token != N.END else list(made)
        return self.complete(context, draw, max_length, (*made, token))


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32


def test_padding_and_windows(spark):
    df = table(spark, [["a", "b"]])
    assert df.select(N.pad(F.col("code_tokens"), 3)).first()[0] == ["<START>", "<START>", "a", "b", "<END>"]
    got = [(r.ctx, r.nxt) for r in N.extract_ngrams(df, 3).orderBy("pos").collect()]
    assert got == [(["<START>"] * 2, "a"), (["<START>", "a"], "b"), (["a", "b"], "<END>")]
    assert N.vocabulary_size(df, 3).first()[0] == 4
    assert N.vocabulary_size(df, 1).first()[0] == 3


def test_windows_of_several_sizes_equal_single_sizes(spark):
    df = table(spark, corpus(1, 20))
    together = N.extract_ngrams(df, [2, 3, 7], keep=["row_ord"])
    for n in (2, 3, 7):
        single = sorted(map(str, N.extract_ngrams(df, n, keep=["row_ord"]).collect()))
        assert sorted(map(str, together.where(F.col("n") == n).collect())) == single


def test_smoothing(rows):
    df = rows([(1, 2), (0, 0)], "c bigint, ct bigint")
    v = F.lit(4)
    for smoothing, k, want in (("none", 1.0, [0.5, 0.0]), ("laplace", 9.0, [2 / 6, 0.25]), ("add-k", 0.1, [1.1 / 2.4, 0.25])):
        p = N.smoothed_probability(F.col("c"), F.col("ct"), v, smoothing, k)
        assert [r[0] for r in df.select(p).collect()] == pytest.approx(want)
    with pytest.raises(ValueError):
        N.smoothed_probability(F.col("c"), F.col("ct"), v, "other")
    with pytest.raises(ValueError):
        N.NGramModel(3, "other")


def test_ties_keep_first_seen_order(spark):
    df = table(spark, [["q", "x"], ["q", "y"], ["q", "y"], ["q", "z"]])
    ranked = N.next_token_topk(N.ngram_counts(df, 2)).where(F.col("ctx") == F.array(F.lit("q")))
    assert [r.nxt for r in ranked.orderBy("rank").collect()] == ["y", "x", "z"]


def test_first_seen_holds_any_order(spark):
    orders = [(1 << 62, ["q", "x"]), (1 << 50, ["q", "y"]), (-(1 << 61), ["q", "z"]), (None, ["q", "n"])]
    ranked = N.next_token_topk(N.ngram_counts(spark.createDataFrame(orders, SCHEMA), 2))
    got = ranked.where(F.col("ctx") == F.array(F.lit("q"))).orderBy("rank").collect()
    assert [r.nxt for r in got] == ["z", "y", "x", "n"]


def test_perplexity_by_hand(spark):
    df = table(spark, [["a", "b"]])
    assert E.perplexity(N.NGramModel(3, "none").fit(df), df).first()[0] == pytest.approx(1.0)
    model = N.NGramModel(2, "none").fit(table(spark, [["a"]]))
    assert E.perplexity(model, table(spark, [["q"]])).first()[0] == pytest.approx(1e10)
    assert E.perplexity(model, df.limit(0)).first()[0] is None


def test_accuracy_limits(spark):
    df = table(spark, [[f"t{i}" for i in range(100)]])
    assert E.topk_accuracy(N.NGramModel(3).fit(df), df).first().total_predictions == 101
    assert E.topk_accuracy(N.NGramModel(3).fit(df), df, max_positions=50).first().total_predictions == 48
    unseen = E.topk_accuracy(N.NGramModel(2).fit(df), table(spark, [[]])).first()
    assert unseen.total_predictions == 1
    nothing = E.topk_accuracy(N.NGramModel(3).fit(df.limit(0)), df).first()
    assert (nothing.total_predictions, nothing.top1_accuracy) == (0, 0.0)


@pytest.mark.parametrize("n", [1, 2, 4])
@pytest.mark.parametrize("smoothing,k", [("none", 1.0), ("laplace", 1.0), ("add-k", 0.3)])
def test_model_equals_plain_python(spark, n, smoothing, k):
    train, test = corpus(2, 40), corpus(3, 15)
    plain = Plain(train, n, smoothing, k)
    asked = table(spark, test)
    model = E.fit_for(N.NGramModel(n, smoothing, k), table(spark, train), asked)
    got = E.perplexity(model, asked).first()
    assert (got.perplexity, got.positions) == pytest.approx(plain.perplexity(test))
    hits = E.topk_accuracy(model, asked).first()
    assert (hits.top1_hits, hits.top3_hits, hits.top5_hits, hits.total_predictions) == plain.accuracy(test)


def test_restriction_changes_nothing(spark, tmp_path):
    train, test = table(spark, corpus(4, 30)), table(spark, corpus(5, 10))
    restricted = E.fit_for(N.NGramModel(3), train, test)
    small, large = E.perplexity(restricted, test).first(), E.perplexity(N.NGramModel(3).fit(train), test).first()
    assert small.perplexity == pytest.approx(large.perplexity) and small.positions == large.positions
    with pytest.raises(ValueError, match="only some contexts"):
        restricted.save(str(tmp_path))


def test_probabilities_sum_to_one(spark):
    df = table(spark, corpus(6, 20))
    tokens = [*WORDS, N.START, N.END]
    pairs = spark.createDataFrame([(c, t) for c in (["a"], ["zz"]) for t in tokens], "ctx array<string>, nxt string")
    for smoothing in ("laplace", "add-k"):
        sums = N.NGramModel(2, smoothing, 0.1).fit(df).score(pairs).groupBy("ctx").agg(F.sum("p").alias("s"))
        assert [r.s for r in sums.collect()] == pytest.approx([1.0, 1.0])


def test_totals_match_counts(spark):
    counts = N.ngram_counts(table(spark, corpus(7, 20)), [2, 5])
    assert counts.agg(F.sum("c")).first() == N.context_totals(counts).agg(F.sum("ct")).first()


GRID = (*E.CONFIGURATIONS, E.Configuration(1, "laplace"), E.Configuration(1, "none"), E.Configuration(2, "add-k", 0.2))


@pytest.mark.parametrize("perplexity_rows,accuracy_rows,positions", [(12, 6, None), (6, 12, 50), (None, 5, 12), (None, None, None)])
def test_grid_equals_single_models(spark, perplexity_rows, accuracy_rows, positions):
    train, test = corpus(8, 40), corpus(9, 16)
    grid = E.score_grid(
        table(spark, train), table(spark, test), GRID, perplexity_rows, accuracy_rows, max_positions=positions
    ).collect()
    assert len(grid) == len(GRID)
    for row, config in zip(grid, GRID):
        plain = Plain(train, config.n, config.smoothing, config.k or 1.0)
        assert row.perplexity == pytest.approx(plain.perplexity(test[:perplexity_rows])[0])
        *hits, total = plain.accuracy(test[:accuracy_rows], positions)
        assert row.total_predictions == total
        assert (row.top1_acc, row.top3_acc, row.top5_acc) == pytest.approx([h / total for h in hits])
        assert row.top1_acc <= row.top3_acc <= row.top5_acc


def test_best_configs(rows):
    df = rows(
        [(0, 3, "none", None, 9.0, 0.5), (1, 3, "add-k", 0.5, 7.0, 0.5), (2, 5, "laplace", None, 7.0, 0.4)],
        "config_ord bigint, n bigint, smoothing string, k double, perplexity double, top1_acc double",
    ).withColumns({"top3_acc": F.lit(1.0), "top5_acc": F.lit(1.0)})
    got = {r.criterion: (r.config_ord, r.model_k) for r in E.best_configs(df).collect()}
    assert got == {"lowest_perplexity": (1, 0.1), "highest_accuracy": (0, 1.0)}


def test_accuracy_by_complexity(spark):
    train, test = corpus(10, 40), corpus(11, 30)
    complexity = [i % 13 for i in range(30)]
    asked = spark.createDataFrame(
        list(zip(range(30), test, complexity)), SCHEMA + ", metrics_cyclomatic_complexity bigint")
    plain = Plain(train, 3)
    got = E.accuracy_by_complexity(N.NGramModel(3).fit(table(spark, train)), asked, 4).collect()
    limits = [(0, 2), (2, 5), (5, 10), (10, 99)]
    assert len(got) == 4
    for row, (low, high) in zip(got, limits):
        chosen = [t for t, c in zip(test, complexity) if low < c <= high][:4]
        top1, _, top5, total = plain.accuracy(chosen)
        assert (row.samples, row.top1_acc, row.top5_acc) == pytest.approx((len(chosen), 100 * top1 / total, 100 * top5 / total))


def test_head_n_and_head_per_group(spark):
    df = spark.range(100).select(F.col("id").alias("row_ord"), (F.col("id") % 2).alias("g")).repartition(5)
    assert sorted(r.row_ord for r in E.head_n(df, 7).collect()) == list(range(7))
    assert E.head_n(df, 0).count() == 0 and E.head_n(df, 500).count() == 100
    assert E.head_n(df, None).count() == E.head_per_group(df, "g").count() == 100
    assert sorted(r.row_ord for r in E.head_per_group(df, "g", 2).collect()) == [0, 1, 2, 3]
    assert E.head_per_group(df, "g", 70).count() == 100


def test_prompt_lengths(spark):
    df = table(spark, [["a"] * 3, ["a"] * 4] + [["a"] * 50] * 200)
    got = {r.row_ord: len(r.context) for r in G.make_prompts(df).collect()}
    assert 0 not in got and got[1] == 3
    assert set(got[i] for i in range(2, 202)) == set(range(3, 11))


def test_backoff_pads_shortened_contexts(spark):
    model = N.NGramModel(3).fit(table(spark, [["a", "b", "c"]]))
    prompts = spark.createDataFrame([(0, ["q", "a"]), (1, ["q", "q"]), (2, [])], "row_ord bigint, context array<string>")
    got = {r.row_ord: r for r in G.backoff_candidates(prompts, model.candidates(), 3).collect()}
    assert got[0].level == 1 and [c.token for c in got[0].candidates] == ["b"]
    assert got[1].candidates is None and got[2].candidates is None


def test_predict(spark):
    train = corpus(12, 40)
    plain = Plain(train, 3)
    model = N.NGramModel(3).fit(table(spark, train))
    contexts = [["a"], ["a", "b"], ["b", "a", "b", "c"], ["zz", "zz"]]
    prompts = spark.createDataFrame(list(enumerate(contexts)), "row_ord bigint, context array<string>")
    got = {r.row_ord: [(p.token, p.prob) for p in r.predictions] for r in model.predict(prompts, 4).collect()}
    for i, context in enumerate(contexts):
        want = plain.top(context, 4)
        assert [t for t, _ in got[i]] == [t for t, _ in want]
        assert [p for _, p in got[i]] == pytest.approx([p for _, p in want])


@pytest.mark.parametrize("n,smoothing", [(1, "laplace"), (2, "laplace"), (4, "none")])
def test_completions_equal_plain_python(spark, n, smoothing):
    train = corpus(13, 60)
    plain = Plain(train, n, smoothing)
    prompts = [(i, t[:4]) for i, t in enumerate(corpus(14, 30)) if len(t) > 4] + [(99, ["zz"])]
    df = spark.createDataFrame(prompts, "row_ord bigint, context array<string>")
    model = N.NGramModel(n, smoothing).fit(table(spark, train))
    got = {r.row_ord: r for r in model.complete(df, 12, seed=7).collect()}
    assert len(got) == len(prompts)
    for i, context in prompts:
        want = plain.complete(context, lambda step: uniform(7, "step", step, i), 12)
        assert got[i].completion == want, (i, context)
    assert n == 1 or got[99].steps == []


def test_stop_tokens(spark):
    one = [(0, ["a"])]
    df = spark.createDataFrame(one, "row_ord bigint, context array<string>")
    for sequence, want in ((["a"], []), (["a", ";", "b"], [";"]), (["a", "b", "}"], ["b", "}"])):
        model = N.NGramModel(2).fit(table(spark, [sequence]))
        assert model.complete(df, 10).first().completion == want


def test_save_and_load(spark, tmp_path):
    df = table(spark, corpus(15, 20))
    model = N.NGramModel(3).fit(df)
    model.save(str(tmp_path))
    loaded = N.FittedNGramModel.load(spark, str(tmp_path), model.settings)
    assert E.perplexity(model, df).first()[0] == pytest.approx(E.perplexity(loaded, df).first()[0])


def test_score_fits_contexts(spark):
    model = N.NGramModel(3).fit(table(spark, [["a", "b", "c"], ["a", "b", "d"]]))
    pairs = spark.createDataFrame(
        [(0, ["x", "y", "a", "b"], "c"), (1, ["a", "b"], "c"), (2, ["a"], "b"), (3, [], "a")], "i int, ctx array<string>, nxt string")
    got = {r.i: (r.ctx, r.c, r.ct) for r in model.score(pairs).collect()}
    assert got == {0: (["a", "b"], 1, 2), 1: (["a", "b"], 1, 2), 2: (["<START>", "a"], 2, 2), 3: (["<START>"] * 2, 2, 2)}
