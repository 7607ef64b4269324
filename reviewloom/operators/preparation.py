"""From raw reviews to a clean two-column table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.labels import threshold_label
from reviewloom.plans import quantiles
from reviewloom.plans.joins import computed_once

QUARTILES = (0.25, 0.5, 0.75)


def label_by_threshold(
    df: DataFrame,
    rating: str,
    positive_from: float = 4,
    negative_below: float = 3,
    out: str = "sentiment",
) -> DataFrame:
    return df.withColumn(out, threshold_label(F.col(rating), positive_from, negative_below))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``, and only rows where none of them is null or NaN. Empty texts stay."""
    return df.select(*columns).dropna(how="any")


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def detach(df: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """The table without ``column``, and the column on its own, both with the key."""
    return df.drop(column), df.select(key, column)


def attach(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Puts a detached column back by its unique key."""
    return features.join(target, key)


def row_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_with_missing(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, a missing value counting as one."""
    value = F.col(column)
    missing = value.isNull() | F.isnan(value) if _is_float(df, column) else value.isNull()
    present = F.when(~missing, value)
    return df.agg(
        (F.count_distinct(present) + F.max(missing.cast("int"))).cast("bigint").alias("n_labels")
    )


def _is_float(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("double", "float")


def describe(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    NaN counts as missing. Quartiles are exact with linear interpolation: :func:`quantiles.at_ranks`
    brackets them by a sketch of the first pass and counts single values inside the brackets only.
    ``approx`` reads them from the sketch instead.
    """
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value"),
        )
        for c in columns
    ]
    # Missing values stay until the aggregates, so a column without any value keeps its row.
    values = df.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")
    base = [
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    names = [f"p{int(q * 100)}" for q in QUARTILES]
    if approx:
        sketch = F.percentile_approx("value", list(QUARTILES), 10_000)
        return (
            values.groupBy("column_name")
            .agg(*base, sketch.alias("__q"))
            .select(
                "column_name", "n", "mean", "std", "min",
                *[F.col("__q")[i].alias(name) for i, name in enumerate(names)], "max",
            )
        )
    present = values.filter(F.col("value").isNotNull())
    sketch = quantiles.bracket_points("value", QUARTILES)
    summary = computed_once(values.groupBy("column_name").agg(*base, sketch.alias("__points")))
    place = {name: F.lit(q) * (F.col("n") - 1) for name, q in zip(names, QUARTILES)}
    wanted = summary.select(
        "column_name",
        "__points",
        *[F.floor(place[name]).alias(f"{name}_low") for name in names],
        *[F.ceil(place[name]).alias(f"{name}_high") for name in names],
    )
    ends = [f"{name}_{end}" for name in names for end in ("low", "high")]
    found = quantiles.at_ranks(present, "column_name", "value", wanted, "__points", len(names), ends)
    # One row per described column, so both sides are as small as the column list.
    joined = summary.drop("__points").join(F.broadcast(found), "column_name", "left")
    shown = []
    for name in names:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        # Equal ends stay as they are, so infinite values need no difference.
        between = low + (high - low) * (place[name] - F.floor(place[name]))
        shown.append(F.when(low == high, low).otherwise(between).alias(name))
    return joined.select("column_name", "n", "mean", "std", "min", *shown, "max")
