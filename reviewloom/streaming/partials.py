"""Utilisation means from partial sums, without state and without loss.

Every micro-batch is reduced to sums per window, device and name, and these are appended to a table; nothing is
kept in between but the time of the newest sample. A window closes when that time has passed its end by the allowed
lateness. Sums that arrive afterwards go to the late part of the table. So means of closed windows are stable,
``corrections`` tells what late samples change, and both parts together are the means over everything.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.metric_names import normal_value
from reviewloom.streaming.utilisation import INTERVAL, kept_samples

KEYS = ["window_start", "device", "name", "family"]
_SUMS = "window_start bigint, device string, name string, family string, total double, n bigint, late boolean, epoch int"
_CLOCK = "newest bigint, epoch int"


def partial_sums(samples: DataFrame) -> DataFrame:
    """(window_start, device, name, family, total, n) of a table or of one micro-batch."""
    kept = kept_samples(samples.withColumn("ts", F.col("ts").cast("timestamp")))
    start = F.unix_timestamp(F.window("ts", INTERVAL)["start"]).alias("window_start")
    return kept.groupBy(start, "device", "name", "family").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _closed(window_start: Column, newest: Column, lateness: int) -> Column:
    """True for windows that ended at least ``lateness`` seconds before the newest sample."""
    return window_start + 5 + lateness <= newest


def write_batch(out: str, lateness: int):
    """A writer of micro-batches; one that is run again replaces its own epoch."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        clocks = _read(spark, f"{out}/clock", _CLOCK).filter(F.col("epoch") < epoch)
        newest = clocks.agg(F.max("newest")).first()[0]
        late = F.lit(False) if newest is None else _closed(F.col("window_start"), F.lit(newest), lateness)
        sums = partial_sums(batch).withColumn("late", late)
        sums.write.mode("overwrite").partitionBy("late").parquet(f"{out}/sums/epoch={epoch}")
        times = batch.agg(F.max(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("newest"))
        times.write.mode("overwrite").parquet(f"{out}/clock/epoch={epoch}")

    return write


def run_partials(samples: DataFrame, out: str, checkpoint: str, lateness: int) -> None:
    """Adds all samples that have arrived to the table ``out``; goes on where the last call stopped."""
    query = (
        samples.writeStream.foreachBatch(write_batch(out, lateness))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def sums(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, f"{out}/sums", _SUMS)


def _means(found: DataFrame) -> DataFrame:
    whole = found.groupBy(*KEYS).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return whole.select(*KEYS, normal_value(F.round(F.col("total") / F.col("n"), 9)).alias("mean"), "n")


def merged_means(spark: SparkSession, out: str) -> DataFrame:
    """Means over every sample so far, on time or late."""
    return _means(sums(spark, out))


def closed_means(spark: SparkSession, out: str, lateness: int) -> DataFrame:
    """Means of the windows that have closed, from the samples that came in time; these rows never change."""
    newest = _read(spark, f"{out}/clock", _CLOCK).agg(F.max("newest")).first()[0]
    in_time = sums(spark, out).filter(~F.col("late"))
    return _means(in_time.filter(_closed(F.col("window_start"), F.lit(newest).cast("bigint"), lateness)))


def corrections(spark: SparkSession, out: str) -> DataFrame:
    """Per window with late samples their number, and its mean over all samples."""
    late = sums(spark, out).filter("late").groupBy(*KEYS).agg(F.sum("n").alias("n_late"))
    return merged_means(spark, out).join(late, KEYS)
