"""The utilisation stream: kept samples, 5-second means, rows per device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.metric_names import (
    device_of,
    family_of,
    is_kept_sample,
    normal_key,
    normal_value,
)

# Fixed value: seconds between two samples.
INTERVAL = "5 seconds"


def kept_samples(samples: DataFrame) -> DataFrame:
    """(ts, device, name, family, value) of the samples that are logged."""
    name = normal_key(F.col("key"))
    return (
        samples.filter(is_kept_sample(F.col("key")))
        .withColumn("name", name)
        .withColumn("device", device_of(F.col("name")))
        .withColumn("family", family_of(F.col("name")))
    )


def window_means(samples: DataFrame, lateness: str | None = None) -> DataFrame:
    """Mean per 5-second window, device and name, for batch and stream alike.

    Means are built from partial sums, so a busy device is no bottleneck. By default every sample counts, however
    late, and a stream keeps the sums of all windows. With ``lateness`` (such as ``10 minutes``) it forgets
    windows that much older than the newest sample, and later samples of these are lost.
    """
    # Partial sums meet in any order: what that adds in the last digits must not decide a tie.
    mean = normal_value(F.round("mean", 9)).alias("mean")
    kept = kept_samples(samples.withColumn("ts", F.col("ts").cast("timestamp")))
    if lateness:
        kept = kept.withWatermark("ts", lateness)
    return (
        kept.groupBy(F.window("ts", INTERVAL), "device", "name", "family")
        .agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
        .select(
            F.unix_timestamp("window.start").alias("window_start"),
            "device", "name", "family", mean, "n",
        )
    )


def utilisation_rows(means: DataFrame) -> DataFrame:
    """One row per window, device and family with its values by name.

    A row has one entry per metric name of the device, at most a few dozen.
    """
    entries = F.sort_array(F.collect_list(F.struct("name", "mean")))
    return means.groupBy("window_start", "device", "family").agg(
        F.map_from_entries(entries).alias("metrics")
    )
