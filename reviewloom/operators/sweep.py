"""Hyper-parameter spaces, sampled trials and their schedule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators import bayes
from reviewloom.operators.classification import MetricRegistry
from reviewloom.plans.storage import materialise

# The learning rates searched by default; the repeated one has double weight.
LEARNING_RATES = (5.5e-5, 5e-5, 4.5e-5, 4e-5, 5.5e-5, 6e-5, 3.5e-5, 6.5e-5)
DEFAULT_SPACE = {"learning_rate": LEARNING_RATES}
MAX_TRIALS = 20
MAX_CONCURRENT = 3


@dataclass(frozen=True)
class LogUniform:
    """Values exp(u) with u even between ``low`` and ``high``."""

    low: float
    high: float


Space = Mapping[str, Sequence | LogUniform]


def _draw(seed: int, experiment: Column, trial: Column, name: str) -> Column:
    """32 random bits from the hash of seed, experiment, trial and parameter."""
    text = F.concat_ws(
        ":", F.lit(str(seed)), experiment.cast("string"), trial.cast("string"), F.lit(name)
    )
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def sample_trials(
    experiments: DataFrame, key: str, space: Space, trials: int = MAX_TRIALS, seed: int = 0
) -> DataFrame:
    """``trials`` random trials per experiment, drawn with replacement. Needs no shuffle."""
    numbered = experiments.select(
        key, F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial_id")
    )
    values = []
    for name, choices in space.items():
        draw = _draw(seed, F.col(key), F.col("trial_id"), name)
        if isinstance(choices, LogUniform):
            unit = draw / F.lit(float(2**32))
            value = F.exp(F.lit(choices.low) + unit * F.lit(choices.high - choices.low))
        else:
            place = F.pmod(draw, F.lit(len(choices))) + 1
            value = F.element_at(F.array(*[F.lit(c) for c in choices]), place.cast("int"))
        values.append(value.alias(name))
    return numbered.select(key, "trial_id", *values)


def grid_trials(experiments: DataFrame, key: str, space: Mapping[str, Sequence]) -> DataFrame:
    """Every distinct combination of the choices, per experiment."""
    grid = experiments.select(key)
    for name, choices in space.items():
        distinct = list(dict.fromkeys(choices))
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(c) for c in distinct])))
    return grid


def schedule(
    trials: DataFrame, trial: str, cap: int = MAX_TRIALS, concurrent: int = MAX_CONCURRENT
) -> DataFrame:
    """Drops trials beyond the cap and tells in which wave each one runs."""
    return trials.filter(F.col(trial) < cap).withColumn(
        "wave", F.floor(F.col(trial) / concurrent).cast("int")
    )


def search(
    model: bayes.NaiveBayes,
    judged: DataFrame,
    key: str,
    text: str,
    label: str,
    trials: Sequence[dict],
    metric: str = "auc_weighted",
    goal: str = "max",
) -> DataFrame:
    """Settings, metrics and ``is_best`` of every trial, stored; the earlier trial wins a tie.

    ``judged`` should be the validation split, so that the test split stays unseen. The trials run
    together in one pass over its texts, not one after the other.
    """
    scores = bayes.score_trials(judged, key, text, label, model, trials)
    settings = judged.sparkSession.createDataFrame(
        [(t["trial_id"], t["alpha"], t["vocab_size"], t["uniform_prior"]) for t in trials],
        "trial_id int, alpha double, vocab_size int, uniform_prior int",
    )
    # A sweep has a handful of trials.
    stored = materialise(settings.join(scores, "trial_id"))
    value = F.round(metric, 9)
    order = value.desc_nulls_last() if goal == "max" else value.asc_nulls_last()
    best = stored.orderBy(order, "trial_id").first()["trial_id"]
    return stored.withColumn("is_best", F.col("trial_id") == best)


def _place(key: str, seed: int) -> Column:
    """Where a row stands from 0 to 1 in a fixed random order."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 4)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(65536.0)


def search_rounds(
    model: bayes.NaiveBayes,
    judged: DataFrame,
    key: str,
    text: str,
    label: str,
    trials: Sequence[dict],
    metric: str = "auc_weighted",
    goal: str = "max",
    shares: Sequence[float] = (0.25, 0.5, 1.0),
    slack: float = 0.1,
    seed: int = 0,
) -> DataFrame:
    """A search that ends trials early: (settings, rounds, rows_judged, metrics, is_best) of every trial.

    Rounds are nested samples of ``judged``, by a hash of the key. A round judges only the rows that the rounds
    before did not, by the trials that are left, and adds its counts to theirs; trials that then fall behind the
    best one by more than the slack (as runs do under the bandit policy) end. The metric is positive. Trials that
    reach the last round are judged on all rows, so if the best one is among them, which the slack is for, it
    is the one that ``search`` finds. The earlier trial wins a tie.
    """
    spark = judged.sparkSession
    placed = judged.withColumn("__place", _place(key, seed))
    alive, ended, before, counts = list(trials), [], 0.0, None
    for number, share in enumerate(shares, 1):
        part = placed.filter((F.col("__place") >= before) & (F.col("__place") < share)).drop("__place")
        before = share
        new = bayes.trial_counts(part, key, text, label, model, alive)
        ids = [t["trial_id"] for t in alive]
        kept = new if counts is None else counts.filter(F.col("trial_id").isin(ids)).unionByName(new)
        counts = materialise(kept.groupBy("trial_id", "label", "pred").agg(F.sum("n").alias("n")))
        rows = {r["trial_id"]: r["n"] for r in counts.groupBy("trial_id").agg(F.sum("n").alias("n")).collect()}
        # A search has a handful of trials.
        scores = {r["trial_id"]: r.asDict() for r in bayes.trial_metrics(counts).collect()}
        values = {i: round(s[metric], 9) for i, s in scores.items() if s[metric] is not None}
        best = (max if goal == "max" else min)(values.values(), default=None)

        def behind(trial: dict, values=values, best=best) -> bool:
            value = values.get(trial["trial_id"])
            if value is None or best is None:
                return False
            return value < best / (1 + slack) if goal == "max" else value > best * (1 + slack)

        last = number == len(shares)
        for trial in alive:
            if last or behind(trial):
                score = scores.get(trial["trial_id"], {})
                ended.append({**trial, **score, "rounds": number, "rows_judged": rows.get(trial["trial_id"], 0)})
        alive = [t for t in alive if not behind(t)]
    names = MetricRegistry().names() + ["auc_weighted"]
    sign = -1 if goal == "max" else 1
    ranked = sorted(
        (e for e in ended if e["rounds"] == len(shares) and e.get(metric) is not None),
        key=lambda e: (sign * round(e[metric], 9), e["trial_id"]),
    )
    winner = ranked[0]["trial_id"] if ranked else None
    return spark.createDataFrame(
        [
            (e["trial_id"], e["alpha"], e["vocab_size"], e["uniform_prior"], e["rounds"], e["rows_judged"],
             *[e.get(n) for n in names], e["trial_id"] == winner)
            for e in ended
        ],
        "trial_id int, alpha double, vocab_size int, uniform_prior int, rounds int, rows_judged bigint, "
        + ", ".join(f"{n} double" for n in names) + ", is_best boolean",
    )


def best_model(model: bayes.NaiveBayes, scores: DataFrame) -> bayes.NaiveBayes:
    """``model`` under the settings of the best trial that ``search`` found, ready to predict with."""
    return model.configured(scores.filter("is_best").first().asDict())
