"""The modelling experiment on a prepared dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import evaluation as E
from ..operators import generation as G
from ..operators.ngrams import NGramModel
from ..session import materialize, stored
from ..sources import sinks as K


@dataclass(frozen=True)
class Experiment:
    results: DataFrame
    best: DataFrame
    by_complexity: DataFrame
    large_scale: DataFrame
    predictions: DataFrame


def run_experiment(
    dataset: DataFrame,
    configurations: Sequence[E.Configuration] = E.CONFIGURATIONS,
    final: NGramModel = NGramModel(5, "laplace"),
    seed: int = 42,
    results_path: str | None = None,
    predictions_path: str | None = None,
    perplexity_rows: int | None = None,
    accuracy_rows: int | None = None,
    rows_per_band: int | None = None,
    large_scale_rows: int | None = None,
    prediction_rows: int | None = None,
    max_positions: int | None = None,
) -> Experiment:
    """Score the grid, examine the most accurate model, and predict with the final one.

    Everything is scored and predicted unless a number of rows or positions is given.
    """
    train, test = E.select_split(dataset, "train"), E.select_split(dataset, "test")
    results = stored(E.score_grid(train, test, configurations, perplexity_rows, accuracy_rows, max_positions=max_positions))
    best = materialize(E.best_configs(results))
    # One row: the settings of the model to build next.
    chosen = best.where("criterion = 'highest_accuracy'").first()
    settings = NGramModel(chosen["n"], chosen["smoothing"], chosen["model_k"])
    # The model is asked about the head of every band and of the whole test split.
    model = E.fit_for(settings, train, test)
    rows = E.head_n(test, prediction_rows)
    predictions = stored(G.prediction_rows(final.fit(train), rows, seed=seed))
    if results_path:
        K.write_results(results, results_path)
    if predictions_path:
        K.write_predictions(predictions, predictions_path)
    return Experiment(
        results.orderBy("config_ord"),
        best,
        E.accuracy_by_complexity(model, test, rows_per_band, max_positions=max_positions),
        E.large_scale_eval(model, test, large_scale_rows, max_positions),
        predictions,
    )
