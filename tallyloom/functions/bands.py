"""Small column functions of the experiment reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive upper end and label of each complexity band.
COMPLEXITY_BANDS = (
    (2.0, "Low (1-2)"),
    (5.0, "Medium (3-5)"),
    (10.0, "High (6-10)"),
    (float("inf"), "Very High (>10)"),
)


def complexity_band(complexity: Column) -> Column:
    """Label of the right-closed band; null for 0, below 0 or missing."""
    (first, label), *others = COMPLEXITY_BANDS
    band = F.when(complexity <= 0, F.lit(None)).when(complexity <= first, label)
    for upper, label in others:
        band = band.when(complexity <= upper, label)
    return band


def band_position(band: Column) -> Column:
    """Order of a band label from low to very high."""
    labels = F.array(*[F.lit(label) for _, label in COMPLEXITY_BANDS])
    return F.array_position(labels, band)


def format_predictions(candidates: Column) -> Column:
    """``token (0.123), token (0.045)`` from an array of (token, prob)."""
    return F.array_join(
        F.transform(candidates, lambda c: F.format_string("%s (%.3f)", c["token"], c["prob"])), ", "
    )


def as_percent(fraction: Column) -> Column:
    """P16."""
    return fraction * 100
