import math
import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import classification as cl


def _pairs(spark, pairs):
    return spark.createDataFrame(pairs, "label int, pred int")


def _row(df):
    return df.first().asDict()


def _brute(pairs):
    classes = sorted({c for p in pairs for c in p})
    out = {"precision": [], "recall": [], "f1": [], "support": []}
    for c in classes:
        hits = sum(l == p == c for l, p in pairs)
        support, predicted = sum(l == c for l, _ in pairs), sum(p == c for _, p in pairs)
        out["precision"].append(hits / predicted if predicted else 0)
        out["recall"].append(hits / support if support else 0)
        out["f1"].append(2 * hits / (support + predicted) if support + predicted else 0)
        out["support"].append(support)
    n = len(pairs)
    result = {k: sum(out[k]) / len(classes) for k in ("precision", "recall", "f1")}
    for k in ("precision", "recall", "f1"):
        result[f"{k}_weighted"] = sum(a * b for a, b in zip(out[k], out["support"])) / n
    result["accuracy"] = sum(l == p for l, p in pairs) / n
    return result


@pytest.mark.parametrize("seed", range(3))
def test_metrics_match_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = [(0 if rng.random() < 0.6 else rng.randrange(1, 4), rng.randrange(5)) for _ in range(200)]
    got = _row(cl.MetricRegistry().compute(cl.confusion(_pairs(spark, pairs), "label", "pred")))
    for name, value in _brute(pairs).items():
        assert math.isclose(got[name], value, abs_tol=1e-12), name
    assert math.isclose(got["recall_weighted"], got["accuracy"])


def test_class_only_in_predictions_counts_in_macro(spark):
    counts = cl.confusion(_pairs(spark, [(0, 0), (1, 1), (1, 2)]), "label", "pred")
    assert math.isclose(_row(cl.macro_metrics(counts))["recall"], (1 + 0.5 + 0) / 3)
    assert math.isclose(_row(cl.weighted_metrics(counts))["recall_weighted"], 2 / 3)


def test_hard_auc(spark):
    pairs = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)]
    counts = cl.confusion(_pairs(spark, pairs), "label", "pred")
    assert math.isclose(_row(cl.auc_hard(counts))["auc"], (6 / 8 + 3 / 4) / 2)
    assert math.isclose(_row(cl.auc_hard(counts))["auc"], _row(cl.macro_metrics(counts))["recall"])


def test_hard_auc_with_a_third_predicted_class(spark):
    pairs = [(0, 0), (0, 2), (1, 1), (1, 2)]
    got = _row(cl.auc_hard(cl.confusion(_pairs(spark, pairs), "label", "pred")))["auc"]
    wins = [1.0 if p > q else 0.5 if p == q else 0.0 for l, p in pairs if l for m, q in pairs if not m]
    assert math.isclose(got, sum(wins) / len(wins))


@pytest.mark.parametrize("pairs, reason", [([(1, 1), (1, 0)], "only one"), ([(0, 0), (1, 1), (2, 2)], "more than two")])
def test_undefined_auc_has_a_reason(spark, pairs, reason):
    row = _row(cl.auc_hard(cl.confusion(_pairs(spark, pairs), "label", "pred")))
    assert row["auc"] is None and row["reason"].startswith(reason)
    evaluated = {r["name"]: r["value"] for r in cl.evaluate(_pairs(spark, pairs), "label", "pred").collect()}
    assert evaluated["test_auc"] is None and evaluated["test_accuracy"] is not None


def test_rank_auc_counts_ties_half(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    assert math.isclose(_row(cl.auc_rank(df, "y", "s"))["auc"], 0.75)
    assert _row(cl.auc_rank(df.filter("y = 1"), "y", "s"))["auc"] is None


def test_rank_auc_with_a_dominant_score(spark):
    rng = random.Random(5)
    rows = [(0.5 if rng.random() < 0.6 else round(rng.random(), 2), rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(6)
    wins = [1.0 if s > t else 0.5 if s == t else 0.0 for s, y in rows if y for t, z in rows if not z]
    assert math.isclose(_row(cl.auc_rank(df, "y", "s"))["auc"], sum(wins) / len(wins))


def test_evaluate_names_and_aliases(spark):
    df = _pairs(spark, [(0, 0), (1, 1), (1, 0)])
    names = {r["name"] for r in cl.evaluate(df, "label", "pred", "train", aliases=True).collect()}
    assert {"train_AUC", "train_AUC_weighted", "train_auc", "train_f1_weighted"} <= names and len(names) == 11


def test_custom_metric(spark):
    registry = cl.MetricRegistry()
    registry.add("worst_recall", lambda: F.min(F.col("hits") / F.col("support")))
    counts = cl.confusion(_pairs(spark, [(0, 0), (1, 1), (1, 0)]), "label", "pred")
    assert _row(registry.compute(counts, ["worst_recall"])) == {"worst_recall": 0.5}
    assert "worst_recall" not in cl.MetricRegistry().names()


def test_excluded_class_and_alignment(spark):
    df = spark.createDataFrame([(1, "OTHER"), (2, "a")], "k int, y string")
    assert [r["k"] for r in cl.exclude_class(df, "y", "OTHER").collect()] == [2]
    preds = spark.createDataFrame([(2, 1), (3, 0)], "k int, pred int")
    assert [tuple(r) for r in cl.align(preds, df, "k").collect()] == [(2, 1, "a")]


def test_areas_leave_out_rows_without_truth(spark):
    rows = [(k % 2, 0.3 * (k % 2) + 0.01 * k, k % 2) for k in range(8)]
    schema = "label int, score double, pred int"
    plain = spark.createDataFrame(rows, schema)
    more = plain.unionByName(spark.createDataFrame([(None, 0.5, k % 2) for k in range(10)], schema))
    for df in (plain, more):
        assert cl.auc_hard(cl.confusion(df, "label", "pred")).first()["auc"] == 1.0
        assert cl.auc_rank(df, "label", "score").first()["auc"] == 1.0
