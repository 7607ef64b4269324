"""Model families on hashed text features, trained with Spark ML, for two or more classes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.labels import argmax
from reviewloom.functions.tokens import words
from reviewloom.operators import bayes, encoding
from reviewloom.operators.classification import MetricRegistry, auc_one_vs_rest, confusion, weighted_area
from reviewloom.plans.joins import lookup_join
from reviewloom.plans.storage import materialise

HASH_FEATURES = 1 << 16


def with_words(df: DataFrame, text: str, label: str) -> DataFrame:
    return df.withColumn("words", words(F.col(text))).withColumn("label", F.col(label).cast("double"))


def with_balance(train: DataFrame, label: str = "label") -> DataFrame:
    """Adds a weight that gives every class the same total."""
    sizes = materialise(train.groupBy(label).agg(F.count(F.lit(1)).alias("__n")))
    total, classes = sizes.agg(F.sum("__n"), F.count(F.lit(1))).first()
    weights = sizes.select(label, (F.lit(total) / (classes * F.col("__n"))).alias("weight"))
    return lookup_join(train, weights, label)


@dataclass(frozen=True)
class OneVsRest:
    """A binary model per class index; the score of a class is its own model's margin.

    With two classes a single model decides, and its margin counts for one and against the other.
    """

    models: list[LinearSVCModel]

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the array ``scores``; all models are applied in one projection."""
        own = rows.columns
        for place, model in enumerate(self.models):
            rows = model.copy().setRawPredictionCol(f"__raw_{place}").setPredictionCol("").transform(rows)
        margins = [vector_to_array(f"__raw_{place}")[1] for place in range(len(self.models))]
        if len(margins) == 1:
            margins = [-margins[0], margins[0]]
        return rows.select(*own, F.array(*margins).alias("scores"))


def one_vs_rest(train: DataFrame, classes: int, fit: Callable[[DataFrame], LinearSVCModel]) -> OneVsRest:
    """Reduces ``classes`` label indices to a binary problem each, over the one stored feature table."""
    told_apart = [1] if classes == 2 else range(classes)
    return OneVsRest(
        [fit(train.withColumn("label", (F.col("label") == place).cast("double"))) for place in told_apart]
    )


def fit_family(train: DataFrame, family: str, max_iter: int = 20, classes: int = 2):
    """``family`` is lr, lr_balanced or svc; ``train`` has features, label and, if balanced, weight.

    Labels are the indices from 0 to ``classes`` - 1, each with a row at least.
    """
    if classes < 2:
        raise ValueError("a classifier needs two classes")
    if family == "svc":
        return one_vs_rest(train, classes, LinearSVC(maxIter=max_iter, regParam=0.01).fit)
    classifier = LogisticRegression(maxIter=max_iter, regParam=0.01)
    if family == "lr_balanced":
        classifier = classifier.setWeightCol("weight")
    return classifier.fit(train)


def featured(train: DataFrame, judged: DataFrame, key: str, text: str, label: str):
    """Training rows with features and weight, and judged rows.

    Features are hashed, weighted token counts; the width is fixed, whatever the vocabulary. The counts of training
    texts are stored for the passes to come, so texts are cut into words and hashed once.
    """
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=HASH_FEATURES)
    counted = materialise(hashed.transform(with_words(train, text, label).select("words", "label")).select("label", "tf"))
    weighted = IDF(inputCol="tf", outputCol="features").fit(counted)
    rows = weighted.transform(counted).select("label", "features")
    others = weighted.transform(hashed.transform(with_words(judged, text, label).select(key, "words", "label")))
    return materialise(with_balance(rows)), others.select(key, "label", "features")


def predictions(model, rows: DataFrame, key: str) -> DataFrame:
    """(key, label, pred, scores): a score per class index, and the first best index."""
    if isinstance(model, OneVsRest):
        scored = model.transform(rows)
    else:
        scored = model.transform(rows).withColumn("scores", vector_to_array("rawPrediction"))
    label = F.col("label").cast("int").alias("label")
    return scored.select(key, label, argmax(F.col("scores")).cast("int").alias("pred"), "scores")


def family_scores(train: DataFrame, judged: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(family, accuracy, f1_weighted, auc_weighted) of every model family on ``judged``.

    Labels may be of any type and number. The area is that of each class's score against the rest, weighted by
    the classes' rows. A judged label that training did not have is never predicted: its rows count as misses.
    """
    label_map = materialise(encoding.fit_label_map(train, label))
    classes = label_map.count()
    if classes < 2:
        raise ValueError("a classifier needs two classes")
    known = encoding.encode_labels(train, label_map, label, "__idx", "skip").drop(label)
    shown = encoding.encode_labels(judged.filter(F.col(label).isNotNull()), label_map, label, "__idx", "keep")
    shown = shown.drop(label).withColumn("__idx", F.coalesce("__idx", F.lit(-1)))
    model = bayes.train(known, text, "__idx")
    together = bayes.predict(shown, key, text, model, ["__idx"]).select(
        F.lit("naive_bayes").alias("family"), F.col("__idx").cast("int").alias("label"), "pred", "scores"
    )
    rows, others = featured(known, shown, key, text, "__idx")
    others = materialise(others)
    for family in ("lr", "lr_balanced", "svc"):
        predicted = predictions(fit_family(rows, family, classes=classes), others, key)
        together = together.unionByName(predicted.select(F.lit(family).alias("family"), "label", "pred", "scores"))
    together = materialise(together)
    counts = materialise(confusion(together, "label", "pred", by=["family"]))
    metrics = MetricRegistry().compute(counts, ["accuracy", "f1_weighted"], by=["family"])
    area = weighted_area(auc_one_vs_rest(together, "label", "scores", by=["family"]), by=["family"])
    return metrics.join(area, "family")


def family_leaderboard(scores: DataFrame, metric: str) -> DataFrame:
    """Families ranked by ``metric``; one row per family."""
    order = Window.orderBy(F.col(metric).desc_nulls_last(), F.col("family"))
    return scores.withColumn("rank", F.rank().over(order))
