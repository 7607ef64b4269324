"""The model registry: newest versions, promotion and retirement."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.operators.runs import best_run, lineage, redirect_family
from reviewloom.plans.joins import lookup_join
from reviewloom.plans.storage import materialise
from reviewloom.sources.manifests import entries, publish


def latest_versions(registry: DataFrame) -> DataFrame:
    """The newest registry row of every model."""
    row = F.struct(*[F.col(c) for c in registry.columns if c != "model_name"])
    newest = F.max_by(row, F.col("version")).alias("newest")
    return registry.groupBy("model_name").agg(newest).select("model_name", "newest.*")


def next_version(registry: DataFrame, model_name: str) -> int:
    newest = registry.filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    return (newest or 0) + 1


def old_versions(registry: DataFrame) -> DataFrame:
    """Every version but the newest of its model: what a promotion would retire."""
    newest = registry.groupBy("model_name").agg(F.max("version").alias("newest"))
    return (
        lookup_join(registry, newest, "model_name")
        .filter(F.col("version") != F.col("newest"))
        .drop("newest")
    )


def replies_of(tried: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, n_valid, n_replies) from scored sample texts: rows with a given text, and those of them with a prediction."""
    given = F.col("text").isNotNull()
    return tried.groupBy(*by).agg(
        F.count(F.when(given, 1)).alias("n_valid"), F.count(F.when(given, F.col("prediction"))).alias("n_replies")
    )


def promotion_plan(registry: DataFrame, smoke: DataFrame) -> DataFrame:
    """What happens to every version once its model's newest one was tried on sample requests.

    The newest version passes when each valid sample got a reply. Then it takes all traffic and
    the others are to be retired; otherwise nothing changes. Nothing is deleted here.
    """
    newest = registry.groupBy("model_name").agg(F.max("version").alias("newest"))
    trial = smoke.select(
        "model_name",
        F.col("version").alias("newest"),
        ((F.col("n_replies") == F.col("n_valid")) & (F.col("n_valid") > 0)).alias("ok"),
    )
    gate = newest.join(trial, ["model_name", "newest"], "left").select(
        "model_name", "newest", F.coalesce("ok", F.lit(False)).alias("passed")
    )
    is_new = F.col("version") == F.col("newest")
    return (
        lookup_join(registry.select("model_name", "version"), gate, "model_name")
        .withColumn(
            "action",
            F.when(is_new & F.col("passed"), F.lit("promote"))
            .when(is_new, F.lit("abort"))
            .when(F.col("passed"), F.lit("retire"))
            .otherwise(F.lit("keep")),
        )
        .withColumn("traffic", F.when(F.col("action") == "promote", 100))
        .drop("newest")
    )


def winner_entry(
    runs: DataFrame,
    metrics: DataFrame,
    inputs: DataFrame,
    registry: DataFrame,
    metric: str,
    model_name: str,
) -> DataFrame:
    """The registry row for the best run over all families, with tags and dataset versions."""
    winner = materialise(redirect_family(best_run(runs, metrics, metric), runs))
    version = next_version(registry, model_name)
    # One row: only its own inputs are traced.
    own = inputs.join(F.broadcast(winner.select(F.col("source_run_id").alias("run_id"))), "run_id", "left_semi")
    traced = winner.join(lineage(own).withColumnRenamed("run_id", "source_run_id"), "source_run_id", "left")
    return traced.select(
        F.lit(model_name).alias("model_name"),
        F.lit(version).cast("bigint").alias("version"),
        F.col("source_run_id").alias("run_id"),
        "is_automl",
        F.create_map(
            F.lit("run_id"), F.col("source_run_id"),
            F.lit("metric_name"), F.lit(metric),
            F.lit("model_name"), F.lit(model_name),
        ).alias("tags"),
        "train_version",
        "val_version",
        F.col("value").alias("metric"),
    )


def append_registry(entry: DataFrame, path: str) -> int:
    """Registers the one row of ``entry`` and returns its version: its own, or the next that no other writer has.

    Each model has its versions in a folder of its own, so any number of writers may register at once.
    """
    row = entry.first().asDict(recursive=True)
    folder = f"{path}/model={quote(row['model_name'], safe='')}"
    return publish(entry.sparkSession, folder, row, row["version"])


def read_registry(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All registered rows, in the columns of the entries' ``schema``."""
    return entries(spark, f"{path}/*", schema)
