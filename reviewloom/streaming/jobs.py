"""Best-so-far tracking, scoring and metric logging on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.functions.metric_names import usable
from reviewloom.operators import bayes
from reviewloom.operators.scoring import score_requests
from reviewloom.plans.storage import scratch_path
from reviewloom.streaming import termination
from reviewloom.streaming.sink import newest_rows, run_available
from reviewloom.streaming.utilisation import window_means


def best_so_far(reports: DataFrame) -> DataFrame:
    """Best value and its first report per run; works on a stream or a table.

    A grouped maximum keeps one row of state per run, whatever the run's share of the reports.
    """
    order = F.struct(F.col("value"), -F.col("seq"))
    return (
        reports.filter(usable(F.col("value")))
        .groupBy("run_id")
        .agg(F.max("value").alias("best"), F.max_by("seq", order).alias("best_seq"))
    )


def stream_best(reports: DataFrame) -> DataFrame:
    tracked = best_so_far(reports)
    return newest_rows(run_available(tracked, "best", tracked.schema), ["run_id"])


def stream_stops(reports: DataFrame, checkpoint: str | None = None, **policy) -> DataFrame:
    """Stops of runs as their reports arrive, each emitted once."""
    decided = termination.stops(reports, **policy)
    return run_available(decided, "stops", decided.schema, "append", checkpoint=checkpoint).drop("epoch")


def stream_window_means(samples: DataFrame) -> DataFrame:
    means = window_means(samples)
    written = run_available(means, "means", means.schema)
    return newest_rows(written, ["window_start", "device", "name", "family"])


def stream_scores(
    requests: DataFrame, model: bayes.NaiveBayes, label_map: DataFrame
) -> DataFrame:
    """Scores every request on arrival; the model is trained once, before the stream starts."""
    label_type = label_map.schema["label"].dataType.simpleString()
    schema = StructType.fromDDL(f"request_id bigint, pos int, prediction {label_type}")
    model = model.prepared()
    return run_available(
        requests, "scores", schema, "append",
        lambda batch: score_requests(batch, model, label_map),
    ).drop("epoch")


def stream_metric_log(metrics: DataFrame) -> DataFrame:
    """Appends metrics to the log as they come; the file sink commits each batch once."""
    spark: SparkSession = metrics.sparkSession
    out = scratch_path(spark, "metric-log")
    query = (
        metrics.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "metric-log-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(metrics.schema).parquet(out)
