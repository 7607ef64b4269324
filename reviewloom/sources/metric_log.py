"""The metric log: an append-only long table, and rows of several named values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.metric_names import first_number
from reviewloom.plans.ordering import sorted_index


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Appends (run_id, name, seq, value) rows."""
    metrics.write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def metric_lists(metrics: DataFrame) -> DataFrame:
    """Values logged under one name, in logging order, numbered from 0.

    Kept as one row per value: a run may hold any share of the log, so its list is never gathered.
    """
    return sorted_index(
        metrics.select("run_id", "name", "seq", "value"), ["run_id", "name"], [F.col("seq")]
    )


def metric_rows(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One wide row per ``keys`` with a column per name; a name logged twice keeps its last value."""
    return metrics.groupBy(*keys).agg(
        *[F.max_by(F.when(F.col("name") == n, F.col("value")),
                   F.when(F.col("name") == n, F.col("seq"))).alias(n) for n in names]
    )


def cast_metrics(logged: DataFrame, text: str = "value") -> DataFrame:
    """Metrics that were logged as text, as numbers; ``rejected`` marks texts that hold none."""
    value = first_number(F.col(text))
    return logged.withColumn("rejected", F.col(text).isNotNull() & value.isNull()).withColumn(text, value)


def cast_report(cast: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """(``by``, n, n_missing, n_rejected) of what ``cast_metrics`` gave: nothing is dropped unseen."""
    rejected = F.count(F.when(F.col("rejected"), 1))
    missing = F.count(F.when(F.col(value).isNull() & ~F.col("rejected"), 1))
    return cast.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), missing.alias("n_missing"), rejected.alias("n_rejected"))
