"""Classification metrics. All class metrics come from one confusion count.

Counting is a grouped count with map-side partial sums, so hot classes cost nothing extra; what
follows works on (classes x classes) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.labels import cross_entropy
from reviewloom.functions.metric_names import prefixed
from reviewloom.plans.joins import local_copy
from reviewloom.plans.ordering import sum_before

# Second spelling of the two area metrics, as older logs have it.
ALIASES = {"auc": "AUC", "auc_weighted": "AUC_weighted"}


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def exclude_class(df: DataFrame, label: str, excluded) -> DataFrame:
    """The rows whose true class is not ``excluded``."""
    return df.filter(F.col(label) != F.lit(excluded))


def align(predictions: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Pairs predictions with their references by the unique example key, not by position."""
    return predictions.join(references, key)


def per_class(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """support, predicted and hits for every class seen in truth or prediction."""
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("pred").alias("cls"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    return (
        counts.select(*by, F.explode(sides).alias("side"))
        .select(*by, "side.*")
        .groupBy(*by, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_precision() -> Column:
    return _ratio(F.col("hits"), F.col("predicted"))


def class_recall() -> Column:
    return _ratio(F.col("hits"), F.col("support"))


def class_f1() -> Column:
    return _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))


def _weighted(score: Column) -> Column:
    return F.sum(score * F.col("support")) / F.sum("support")


# name -> aggregate over the per-class rows (columns cls, support, predicted, hits).
_METRICS: dict[str, Callable[[], Column]] = {
    "accuracy": lambda: F.sum("hits") / F.sum("support"),
    "precision": lambda: F.avg(class_precision()),
    "recall": lambda: F.avg(class_recall()),
    "f1": lambda: F.avg(class_f1()),
    "precision_weighted": lambda: _weighted(class_precision()),
    "recall_weighted": lambda: _weighted(class_recall()),
    "f1_weighted": lambda: _weighted(class_f1()),
}


class MetricRegistry:
    """Class metrics by name; users add their own as aggregate expressions."""

    def __init__(self):
        self._metrics = dict(_METRICS)

    def add(self, name: str, aggregate: Callable[[], Column]) -> None:
        self._metrics[name] = aggregate

    def names(self) -> list[str]:
        return list(self._metrics)

    def compute(
        self, counts: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()
    ) -> DataFrame:
        """One row (per ``by``) with a column per metric."""
        wanted = list(names) if names is not None else self.names()
        return per_class(counts, by).groupBy(*by).agg(
            *[self._metrics[name]().alias(name) for name in wanted]
        )


def macro_metrics(counts: DataFrame) -> DataFrame:
    return MetricRegistry().compute(counts, ["precision", "recall", "f1"])


def weighted_metrics(counts: DataFrame) -> DataFrame:
    return MetricRegistry().compute(
        counts, ["precision_weighted", "recall_weighted", "f1_weighted"]
    )


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def _area(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Area under the ROC curve from rows (score, pos, neg, neg_before), null when undefined."""
    classes = F.max("n_classes")
    area = F.try_divide(
        F.sum(F.col("pos") * (F.col("neg_before").cast("double") + F.col("neg") / 2)),
        F.sum("pos").cast("double") * F.sum("neg"),
    )
    return scored.groupBy(*by).agg(
        F.when(classes == 2, area).alias("auc"),
        F.when(classes < 2, F.lit("only one class in the truth"))
        .when(classes > 2, F.lit("more than two classes in the truth"))
        .alias("reason"),
    )


def auc_hard(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC with the predicted class itself as score; the greater of two true classes is positive.

    Rows without a truth are left out.
    """
    counts = counts.filter(F.col("label").isNotNull())
    truth = counts.groupBy(*by).agg(
        F.max("label").alias("positive"), F.count_distinct("label").alias("n_classes")
    )
    if by:
        joined = counts.join(truth, list(by))
    else:
        positive, n_classes = truth.first()
        joined = counts.withColumn("positive", F.lit(positive)).withColumn(
            "n_classes", F.lit(n_classes)
        )
    is_positive = F.col("label") == F.col("positive")
    per_score = joined.groupBy(*by, F.col("pred").alias("score")).agg(
        F.sum(F.when(is_positive, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(is_positive, 0).otherwise(F.col("n"))).alias("neg"),
        F.max("n_classes").alias("n_classes"),
    )
    # One row per predicted class.
    earlier = Window.partitionBy(*by).orderBy("score")
    running = per_score.withColumn("neg_before", F.sum("neg").over(earlier) - F.col("neg"))
    return _area(running, by)


def auc_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact, tie-aware AUC of a score column: equal scores count half. Rows without a truth are left out.

    Rows are counted per distinct score first; the running count of negatives over the scores is
    spread over range partitions.
    """
    df = df.filter(F.col(label).isNotNull())
    truth = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    positive, n_classes = truth.agg(F.max("label"), F.count(F.lit(1))).first()
    is_positive = F.col(label) == F.lit(positive)
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(is_positive, 1)).alias("pos"),
        F.count(F.when(~is_positive, 1)).alias("neg"),
    )
    running = sum_before(per_score, [], [F.col("score")], "neg", "neg_before")
    return _area(running.withColumn("n_classes", F.lit(n_classes)), [])


def auc_one_vs_rest(df: DataFrame, label: str, scores: str, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, cls, support, auc): exact, tie-aware AUC of each class's score for telling it from the rest.

    ``scores`` is an array by class index and ``label`` the true index. Counts per distinct (class, score) go through
    one range exchange, whatever the number of classes; a class without rows, or with all of them, has no area.
    Rows without a truth are left out.
    """
    told = df.filter(F.col(label).isNotNull()).select(
        *by, F.col(label).alias("__label"), F.posexplode(scores).alias("cls", "score")
    )
    own = F.col("__label") == F.col("cls")
    per_score = told.groupBy(*by, "cls", "score").agg(
        F.count(F.when(own, 1)).alias("pos"), F.count(F.when(~own, 1)).alias("neg")
    )
    running = sum_before(per_score, [*by, "cls"], [F.col("score")], "neg", "neg_before")
    area = F.try_divide(
        F.sum(F.col("pos") * (F.col("neg_before").cast("double") + F.col("neg") / 2)),
        F.sum("pos").cast("double") * F.sum("neg"),
    )
    return running.groupBy(*by, "cls").agg(F.sum("pos").alias("support"), area.alias("auc"))


def weighted_area(areas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means of the classes' areas: weighted by support, and plain. Classes without an area are left out."""
    return areas.filter(F.col("auc").isNotNull()).groupBy(*by).agg(
        (F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc_weighted"), F.avg("auc").alias("auc_macro")
    )


def log_loss(df: DataFrame, logits: str, label: str) -> DataFrame:
    return df.agg(F.avg(cross_entropy(F.col(logits), F.col(label))).alias("loss"))


def evaluate(
    df: DataFrame, label: str, pred: str, prefix: str = "test", aliases: bool = False
) -> DataFrame:
    """The full metric row as (name, value) rows named ``prefix_metric``."""
    counts = confusion(df, label, pred)
    known = local_copy(counts)
    counts = counts if known is None else known
    names = MetricRegistry().names()
    row = MetricRegistry().compute(counts)
    # Column names ignore case, so both spellings are only ever values.
    areas = [*ALIASES, *ALIASES.values()] if aliases else list(ALIASES)
    area = auc_hard(counts).select(
        F.explode(F.array(*[F.lit(name) for name in areas])).alias("name"), F.col("auc").alias("value")
    )
    rows = row.unpivot([], names, "name", "value").unionByName(area)
    return rows.select(prefixed(F.col("name"), prefix).alias("name"), "value")
