"""Analytics over run trees and metric logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.metric_names import usable
from reviewloom.plans.joins import lookup_join, skew_join, stored_lookup_join
from reviewloom.plans.ordering import competition_rank, running_max, sorted_index
from reviewloom.plans.storage import materialise

# The mark of the second model family, and the name of its search step.
FAMILY_MARK = "AutoML"
FAMILY_STEP = "AutoML_Classification"
# Dataset roles by the name a run uses for its input.
ROLES = {"train_set": "train_version", "val_set": "val_version", "test_set": "test_version"}


def flatten_runs(runs: DataFrame) -> DataFrame:
    """(run_id, root_id, depth) for every run that a root reaches; ``unreached_runs`` are the others.

    Most runs are leaves, so only parents are resolved step by step: each round doubles the known
    distance, so a tree of depth d takes log2(d) rounds. Leaves then look up their parent once.
    A round that brings no run to its root leaves cycles only, which have none.
    """
    links = materialise(runs.select("run_id", "parent_id"))
    parents = links.select(F.col("parent_id").alias("run_id")).filter("run_id IS NOT NULL").distinct()
    inner = links.join(parents, "run_id", "left_semi")
    known = materialise(
        inner.select(
            "run_id",
            F.coalesce("parent_id", "run_id").alias("top"),
            F.col("parent_id").isNotNull().cast("int").alias("depth"),
        )
    )
    waiting = None
    while True:
        ahead = known.select(
            F.col("run_id").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more")
        )
        moved = materialise(
            stored_lookup_join(known, ahead, "top").select(
                "run_id", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("more") > 0).alias("moved"),
            )
        )
        known = moved.drop("moved")
        before, waiting = waiting, moved.filter("moved").count()
        if waiting in (0, before):
            break
    known = moved.filter("NOT moved").drop("moved")
    roots = links.filter(F.col("parent_id").isNull()).select(
        "run_id", F.col("run_id").alias("root_id"), F.lit(0).alias("depth")
    )
    above = known.select(
        F.col("run_id").alias("parent_id"), F.col("top").alias("root_id"), F.col("depth").alias("up")
    )
    children = links.filter(F.col("parent_id").isNotNull())
    below = stored_lookup_join(children, above, "parent_id").select(
        "run_id", "root_id", (F.col("up") + 1).alias("depth")
    )
    return roots.unionByName(below)


def unreached_runs(runs: DataFrame, flat: DataFrame) -> DataFrame:
    """Runs that no root reaches: they lie on or below a cycle, or below a run that is missing."""
    return runs.join(flat.select("run_id"), "run_id", "left_anti")


def runs_with_metric(runs: DataFrame, metrics: DataFrame, name: str) -> DataFrame:
    carrying = metrics.filter(F.col("name") == name).select("run_id").distinct()
    return runs.join(carrying, "run_id", "left_semi")


def run_by_id_part(runs: DataFrame, part: str) -> DataFrame:
    """The earliest run whose id holds ``part``; an empty part matches every run."""
    return runs.filter(F.contains(F.col("run_id"), F.lit(part))).orderBy("seq").limit(1)


def run_by_name(runs: DataFrame, name: str) -> DataFrame:
    """The earliest run of exactly this name; reading it fails if there is none."""
    found = _earliest(runs, name).agg(F.first(F.struct(*runs.columns)).alias("run"))
    missing = F.raise_error(F.lit(f"no run is named {name}"))
    return found.select(F.when(F.col("run").isNull(), missing).otherwise(F.col("run")).alias("run")).select("run.*")


def _earliest(runs: DataFrame, name: str) -> DataFrame:
    return runs.filter(F.col("name") == name).orderBy("seq").limit(1)


def with_family(runs: DataFrame) -> DataFrame:
    """Marks the runs of the second model family by their name."""
    return runs.withColumn("is_automl", F.contains(F.col("name"), F.lit(FAMILY_MARK)))


def redirect_family(winner: DataFrame, runs: DataFrame) -> DataFrame:
    """A winner of the second family stands for that family's search step, which must exist."""
    step = _earliest(runs, FAMILY_STEP).select(
        F.lit(True).alias("is_automl"), F.col("run_id").alias("step_id")
    )
    return (
        with_family(winner)
        .join(F.broadcast(step), "is_automl", "left")
        .withColumn(
            "source_run_id",
            F.when(~F.col("is_automl"), F.col("run_id"))
            .when(F.col("step_id").isNull(), F.raise_error(F.lit(f"no run is named {FAMILY_STEP}")))
            .otherwise(F.col("step_id")),
        )
        .drop("step_id")
    )


def run_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per run and metric: first and last value and how many were logged."""
    summary = metrics.groupBy("run_id", F.col("name").alias("metric")).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.min_by("value", "seq").alias("first_value"),
        F.max_by("value", "seq").alias("last_value"),
    )
    return skew_join(summary, runs.select("run_id", F.col("name").alias("run_name")), "run_id")


def first_values(metrics: DataFrame, name: str) -> DataFrame:
    """The first logged value of a metric per run, where it is a number."""
    return (
        metrics.filter(F.col("name") == name)
        .groupBy("run_id")
        .agg(F.min_by("value", "seq").alias("value"))
        .filter(usable(F.col("value")))
    )


def scored_runs(runs: DataFrame, metrics: DataFrame, name: str) -> DataFrame:
    """Runs with their score; one row per run on both sides."""
    return runs.join(first_values(metrics, name), "run_id")


def _best_first(goal: str) -> Column:
    return F.col("value").desc() if goal == "max" else F.col("value").asc()


def best_run(runs: DataFrame, metrics: DataFrame, name: str, goal: str = "max") -> DataFrame:
    """The run with the best first value; the earlier run wins a tie."""
    return scored_runs(runs, metrics, name).orderBy(_best_first(goal), F.col("seq")).limit(1)


def best_value(metrics: DataFrame, name: str, goal: str = "max") -> DataFrame:
    pick = F.max if goal == "max" else F.min
    return first_values(metrics, name).agg(pick("value").alias("best_value"))


def run_counts(runs: DataFrame, metrics: DataFrame, name: str) -> DataFrame:
    """Runs looked at, and runs that carry the metric."""
    carrying = metrics.filter(F.col("name") == name).select("run_id").distinct()
    flagged = runs.select("run_id").join(
        carrying.withColumn("carries", F.lit(1)), "run_id", "left"
    )
    return flagged.agg(
        F.count(F.lit(1)).alias("n_examined"), F.count("carries").alias("n_valid")
    )


def best_child(runs: DataFrame, metrics: DataFrame, name: str, goal: str = "max") -> DataFrame:
    """Per parent its best child; a grouped maximum, so parents of many children are no problem."""
    scored = scored_runs(runs, metrics, name).filter(F.col("parent_id").isNotNull())
    sign = 1 if goal == "max" else -1
    order = F.struct(sign * F.col("value"), -F.col("seq"))
    winner = F.max_by(F.struct(F.col("run_id"), F.col("value")), order).alias("winner")
    return scored.groupBy("parent_id").agg(winner).select("parent_id", "winner.*")


def best_checkpoint(losses: DataFrame) -> DataFrame:
    """Per run the checkpoint with the lowest loss, the earlier one on a tie."""
    order = F.struct(F.col("loss"), F.col("epoch"))
    return losses.filter(usable(F.col("loss"))).groupBy("run_id").agg(
        F.min_by("epoch", order).alias("epoch"), F.min("loss").alias("loss")
    )


def leaderboard(scores: DataFrame, experiment: str, value: str, run: str) -> DataFrame:
    """Competition rank of every run inside its experiment, best first."""
    return competition_rank(scores.filter(usable(F.col(value))), [experiment], value, run)


def lineage(inputs: DataFrame) -> DataFrame:
    """Per run the dataset versions it trained, validated and tested on; the last one listed wins."""
    picks = []
    for name, column in ROLES.items():
        listed = F.col("name") == name
        picks.append(
            F.max_by(
                F.when(listed, F.col("version")),
                F.when(listed, F.struct(F.col("seq"), F.col("version"))),
            ).alias(column)
        )
    return inputs.groupBy("run_id").agg(*picks)


def numbered_intervals(reports: DataFrame, order: list[Column]) -> DataFrame:
    """Numbers the reports of each run from 1; a run may hold any share of them."""
    return sorted_index(reports, ["run_id"], order, "interval_no").withColumn(
        "interval_no", F.col("interval_no") + 1
    )


def bandit_stops(
    curve: DataFrame, interval: int = 5, slack: float = 0.1, goal: str = "max"
) -> DataFrame:
    """First evaluation at which each run falls behind the best run by more than the slack.

    At every ``interval``-th report the run's best value so far is held against the best value of
    any run so far. The metric is positive. Both running maxima are scanned in bounded chunks.
    """
    sign = 1.0 if goal == "max" else -1.0
    signed = materialise(
        curve.select("run_id", "interval_no", (F.lit(sign) * F.col("value")).alias("value"))
    )
    own = running_max(signed, ["run_id"], "interval_no", "value", "own_best")
    peaks = signed.groupBy("interval_no").agg(F.max("value").alias("value"))
    overall = running_max(peaks, [], "interval_no", "value", "best").select("interval_no", "best")
    due = (F.col("interval_no") % interval) == 0
    allowed = F.lit(1 + slack)
    threshold = F.col("best") / allowed if goal == "max" else F.col("best") * allowed
    checked = lookup_join(own.filter(due), overall.filter(due), "interval_no")
    return (
        checked.filter(F.col("own_best") < threshold)
        .groupBy("run_id")
        .agg(F.min("interval_no").alias("stopped_at"))
    )
