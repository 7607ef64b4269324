"""Model families on two and more classes, with known values."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import candidates, classification
from reviewloom.plans.storage import materialise

OWN = {"de": "und das ist", "en": "and the is", "fr": "et le est", "es": "y el es"}


def _texts(n, labels, seed=0, start=0):
    """Every class has words of its own, among words that all share."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        label = labels[k % len(labels)]
        own = rng.choices(OWN.get(label, f"x{label} y{label}").split(), k=4)
        rows.append((start + k, " ".join(own + rng.choices("a b c d e".split(), k=4)), label))
    return rows


@pytest.mark.parametrize("labels", [["de", "en", "fr"], [7, 3]])
def test_families_on_separable_classes(spark, labels, monkeypatch):
    monkeypatch.setattr(candidates, "HASH_FEATURES", 1 << 10)
    kind = "string" if isinstance(labels[0], str) else "bigint"
    train = spark.createDataFrame(_texts(60, labels), f"k bigint, text string, y {kind}")
    judged = spark.createDataFrame(_texts(24, labels, 1, 100), f"k bigint, text string, y {kind}")
    scores = candidates.family_scores(train, judged, "k", "text", "y")
    rows = {r["family"]: r for r in candidates.family_leaderboard(scores, "auc_weighted").collect()}
    assert set(rows) == {"naive_bayes", "lr", "lr_balanced", "svc"}
    assert all((r["accuracy"], r["f1_weighted"], r["auc_weighted"]) == (1.0, 1.0, 1.0) for r in rows.values())
    # Equal families keep the order of their names.
    assert sorted(rows, key=lambda f: rows[f]["rank"]) == sorted(rows)


def test_labels_that_training_did_not_have_are_misses(spark):
    train = spark.createDataFrame(_texts(40, ["de", "en"]), "k bigint, text string, y string")
    more = _texts(20, ["de", "en"], 1, 100) + _texts(5, ["fr"], 2, 200) + [(300, "und", None)]
    judged = spark.createDataFrame(more, "k bigint, text string, y string")
    scores = {r["family"]: r for r in candidates.family_scores(train, judged, "k", "text", "y").collect()}
    assert all(abs(r["accuracy"] - 20 / 25) < 1e-12 for r in scores.values())
    with pytest.raises(ValueError, match="two classes"):
        candidates.family_scores(train.filter("y = 'de'"), judged, "k", "text", "y")


def test_predictions_of_the_reduction_are_the_largest_margin(spark):
    labels = ["de", "en", "fr"]
    coded = {label: float(i) for i, label in enumerate(labels)}
    rows = spark.createDataFrame([(k, t, coded[y]) for k, t, y in _texts(45, labels)], "k bigint, text string, label double")
    train, judged = candidates.featured(rows, rows, "k", "text", "label")
    model = candidates.fit_family(train, "svc", classes=3)
    assert len(model.models) == 3
    got = candidates.predictions(model, judged, "k").collect()
    assert all(r["pred"] == r["label"] == max(range(3), key=r["scores"].__getitem__) for r in got)
    # A class's margin is its own model's: the features times the weights and the constant.
    features = {r["k"]: r["features"] for r in judged.collect()}
    for r in got[:10]:
        for own, score in zip(model.models, r["scores"]):
            assert abs(own.coefficients.dot(features[r["k"]]) + own.intercept - score) < 1e-9
    two = candidates.fit_family(train.filter("label < 2"), "svc", classes=2)
    assert all(abs(r["scores"][0] + r["scores"][1]) < 1e-12 for r in candidates.predictions(two, judged, "k").collect())


@pytest.mark.parametrize("large", [False, True])
def test_class_weights(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    df = spark.createDataFrame([(0.0,)] * 8 + [(1.0,)] * 2 + [(2.0,)] * 5, "label double")
    got = candidates.with_balance(df).groupBy("label").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    assert {r["label"]: (round(r["w"], 9), r["n"]) for r in got} == {0.0: (5.0, 8), 1.0: (5.0, 2), 2.0: (5.0, 5)}


def test_ranks_of_families(spark):
    rows = [("a", 0.5), ("b", 0.9), ("c", None), ("d", 0.5)]
    ranked = candidates.family_leaderboard(spark.createDataFrame(rows, "family string, f double"), "f")
    assert {r["family"]: r["rank"] for r in ranked.collect()} == {"b": 1, "a": 2, "d": 3, "c": 4}


def test_area_of_each_class_against_the_rest(spark):
    rng = random.Random(3)
    rows = [(f, rng.randrange(3) if k else None, [round(rng.random(), 1) for _ in range(4)]) for f in "pq" for k in range(40)]
    df = spark.createDataFrame(rows, "f string, y int, s array<double>")
    areas = classification.auc_one_vs_rest(df, "y", "s", by=["f"])
    got = {(r["f"], r["cls"]): r for r in areas.collect()}
    means = {r["f"]: r for r in classification.weighted_area(areas, by=["f"]).collect()}
    for f in "pq":
        own = [(y, s) for g, y, s in rows if g == f and y is not None]
        support = Counter(y for y, _ in own)
        want = {}
        for c in range(4):
            pos, neg = [s[c] for y, s in own if y == c], [s[c] for y, s in own if y != c]
            assert got[f, c]["support"] == support[c]
            if not pos:
                assert got[f, c]["auc"] is None
                continue
            want[c] = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
            assert abs(got[f, c]["auc"] - want[c]) < 1e-12
        assert abs(means[f]["auc_weighted"] - sum(want[c] * support[c] for c in want) / sum(support.values())) < 1e-12
        assert abs(means[f]["auc_macro"] - sum(want.values()) / len(want)) < 1e-12


def test_texts_are_stored_as_counts_before_the_passes(spark, monkeypatch):
    """Weights are learned from stored counts, so no pass cuts training texts into words again."""
    kept = []
    monkeypatch.setattr(candidates, "materialise", lambda df: kept.append(df.columns) or materialise(df))
    rows = spark.createDataFrame([(i, f"word{i % 3} other", i % 2) for i in range(12)], "k int, text string, label int")
    train, _ = candidates.featured(rows, rows, "k", "text", "label")
    assert kept[0] == ["label", "tf"]
    assert "regexp" not in train._jdf.queryExecution().optimizedPlan().toString()
    assert train.columns == ["label", "features", "weight"] and train.count() == 12
