"""Exact order statistics in two passes: a sketch brackets the ranks, then single values are counted
inside the brackets only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.joins import computed_once
from reviewloom.plans.ordering import sum_before
from reviewloom.plans.storage import materialise

# The sketch errs by one part in ACCURACY of the rows; brackets reach SPREAD of the rows to each side.
ACCURACY = 10_000
SPREAD = 0.0005


def bracket_points(value: str, shares: Sequence[float]) -> Column:
    """Aggregate: lower and upper bracket end for each of the rising ``shares``, as one array."""
    points = [end for q in shares for end in (max(q - SPREAD, 0.0), min(q + SPREAD, 1.0))]
    return F.percentile_approx(value, points, ACCURACY)


def _counted(df: DataFrame, group: str, value: str, brackets: int) -> DataFrame:
    """Copies per value, where values outside all brackets (``__low0``, ``__high0``, ...) share one row per gap.

    ``__passed`` is the number of brackets that end before the value, so gaps and bracketed values
    sort by (__passed, __inside, value). Plain comparisons, which are compiled with the scan.
    """
    v = F.col(value)
    entered = passed = F.lit(0)
    for i in range(brackets):
        entered = entered + (v >= F.col(f"__low{i}")).cast("int")
        passed = passed + (v > F.col(f"__high{i}")).cast("int")
    keys = df.select(
        group,
        passed.alias("__passed"),
        (entered > passed).alias("__inside"),
        F.when(entered > passed, v).alias(value),
    )
    return keys.groupBy(group, "__passed", "__inside", value).agg(F.count(F.lit(1)).alias("__copies"))


def _values_at(counted: DataFrame, group: str, value: str, wanted: DataFrame, ranks: Sequence[str]) -> DataFrame:
    """The value at each rank, null where a gap holds the rank."""
    order = [F.col("__passed"), F.col("__inside"), F.col(value)]
    running = sum_before(materialise(counted), [group], order, "__copies", "__before")

    def held(rank: str) -> Column:
        return (F.col("__before") <= F.col(rank)) & (F.col(rank) < F.col("__before") + F.col("__copies"))

    # ``wanted`` has one row a group.
    picks = [F.max(F.when(held(r) & F.col("__inside"), F.col(value))).alias(r) for r in ranks]
    return running.join(F.broadcast(wanted.select(group, *ranks)), group).groupBy(group).agg(*picks)


def at_ranks(
    df: DataFrame, group: str, value: str, wanted: DataFrame, points: str, brackets: int, ranks: Sequence[str]
) -> DataFrame:
    """One row per group: the values at its 0-based ``ranks``; ``value`` holds neither null nor NaN.

    ``wanted`` is small and computed already: per group the columns ``ranks`` and the array ``points`` of
    :func:`bracket_points`, with two ends for each of ``brackets``. The counts of the gaps prove that a bracket holds its rank. Groups
    without that proof are counted again with a bracket over everything.
    """
    known = wanted.filter(F.col(points).isNotNull())
    ends = [
        F.get(points, F.lit(2 * i + side)).alias(f"__{end}{i}")
        for i in range(brackets)
        for side, end in enumerate(("low", "high"))
    ]
    bracketed = df.join(F.broadcast(known.select(group, *ends)), group)
    counted = _counted(bracketed, group, value, brackets)
    found = computed_once(_values_at(counted, group, value, known, ranks))
    unproved = F.lit(False)
    for rank in ranks:
        unproved = unproved | F.col(rank).isNull()
    missed = found.filter(unproved).select(group)
    if missed.isEmpty():
        return found
    whole = missed.withColumn("__low0", F.lit(float("-inf"))).withColumn("__high0", F.lit(float("inf")))
    counted = _counted(df.join(F.broadcast(whole), group), group, value, 1)
    return found.filter(~unproved).unionByName(_values_at(counted, group, value, known, ranks))
