"""Labels from ratings, and class choice from score arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold_label(rating: Column, positive_from: float = 4, negative_below: float = 3) -> Column:
    """1.0 from ``positive_from`` on, 0.0 below ``negative_below``, null between or without a rating.

    NaN compares greater than every number in Spark, so it is ruled out first.
    """
    return (
        F.when(rating.isNull() | F.isnan(rating), F.lit(None).cast("double"))
        .when(rating >= positive_from, F.lit(1.0))
        .when(rating < negative_below, F.lit(0.0))
    )


def argmax(scores: Column) -> Column:
    """0-based place of the first maximum; NaN counts as the maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(logits: Column, label: Column) -> Column:
    """-log softmax(logits)[label], shifted by the maximum against overflow."""
    peak = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z - peak))
    return F.log(total) + peak - F.element_at(logits, (label + 1).cast("int"))
