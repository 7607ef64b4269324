"""Searches that end trials early, and the gate on given replies."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import bayes, model_registry, sweep
from reviewloom.operators.scoring import score_texts
from reviewloom.plans.storage import materialise
from reviewloom.sources.requests import parse_requests

GOOD, BAD, PLAIN = ["good", "fine", "great"], ["bad", "poor", "awful"], ["the", "a", "of", "it", "and", "so"]


def _texts(n, seed, start=0):
    """One rare word in a text tells the class, so a vocabulary of common words alone cannot."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        label = int(rng.random() < 0.5)
        rows.append((start + k, " ".join([rng.choice(GOOD if label else BAD)] + rng.choices(PLAIN, k=12)), label))
    return rows


def _trials():
    settings = [(1.0, 3, 0), (1.0, 0, 0), (0.1, 0, 1), (1.0, 4, 1), (50.0, 0, 0)]
    return [
        {"trial_id": i, "alpha": a, "vocab_size": v, "uniform_prior": u} for i, (a, v, u) in enumerate(settings)
    ]


@pytest.fixture(scope="module")
def trained(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k bigint, text string, y int")
    return bayes.train(frame(_texts(300, 0)), "text", "y"), materialise(frame(_texts(400, 1, 1000)))


def test_rounds_find_the_winner_of_the_full_search(spark, trained):
    model, judged = trained
    full = {r["trial_id"]: r for r in sweep.search(model, judged, "k", "text", "y", _trials(), "accuracy").collect()}
    assert len({round(r["accuracy"], 6) for r in full.values()}) >= 3
    rounds = {r["trial_id"]: r for r in sweep.search_rounds(model, judged, "k", "text", "y", _trials(), "accuracy").collect()}
    assert set(rounds) == set(full)
    assert [i for i, r in rounds.items() if r["is_best"]] == [i for i, r in full.items() if r["is_best"]]
    place = F.conv(F.substring(F.md5(F.concat(F.lit("0:"), F.col("k").cast("string"))), 1, 4), 16, 10).cast("bigint") / 65536
    seen = [judged.filter(place < share).count() for share in (0.25, 0.5, 1.0)]
    for i, r in rounds.items():
        assert r["rows_judged"] == seen[r["rounds"] - 1]
        if r["rounds"] == 3:  # judged on every row, in parts that add up
            assert all(abs(r[m] - full[i][m]) < 1e-12 for m in ("accuracy", "f1_weighted", "recall", "auc_weighted"))
    # Trials that only know common words end at once, and their rows are saved.
    assert rounds[0]["rounds"] == 1 and rounds[3]["rounds"] == 1 and rounds[1]["rounds"] == 3
    assert sum(r["rows_judged"] for r in rounds.values()) < 0.8 * 5 * 400


def test_rounds_without_slack_for_ties_and_without_rows(spark, trained):
    model, judged = trained
    same = [{**_trials()[1], "trial_id": i} for i in (4, 2, 9)]
    rows = {r["trial_id"]: r for r in sweep.search_rounds(model, judged, "k", "text", "y", same, "accuracy", slack=0.0).collect()}
    assert [i for i, r in rows.items() if r["is_best"]] == [2] and all(r["rounds"] == 3 for r in rows.values())
    nothing = sweep.search_rounds(model, judged.limit(0), "k", "text", "y", same, "accuracy").collect()
    assert {(r["rounds"], r["rows_judged"], r["accuracy"], r["is_best"]) for r in nothing} == {(3, 0, None, False)}
    worst = sweep.search_rounds(model, judged, "k", "text", "y", _trials(), "accuracy", goal="min").collect()
    assert [r["trial_id"] for r in worst if r["is_best"]] and next(r for r in worst if r["trial_id"] == 1)["rounds"] == 1


def test_gate_on_given_replies(spark, trained):
    model, _ = trained
    raw = [(1, '{"data": [{"text": "good the"}, {"text": null}, {"text": "bad a"}]}'), (2, '{"data": []}'), (3, "junk")]
    sent = parse_requests(spark.createDataFrame(raw, "request_id bigint, raw string"))
    whole = spark.createDataFrame([("no", 0), ("yes", 1)], "label string, idx bigint")
    tried = None
    for name, own in (("whole", whole), ("partial", whole.filter("idx = 1"))):
        answered = sent.join(score_texts(sent, model, own), ["request_id", "pos"], "left").withColumn("model_name", F.lit(name))
        tried = answered if tried is None else tried.unionByName(answered)
    replies = model_registry.replies_of(tried, ["model_name"])
    assert {tuple(r) for r in replies.collect()} == {("whole", 2, 2), ("partial", 2, 1)}
    versions = spark.createDataFrame([(m, v) for m in ("whole", "partial", "untried") for v in (1, 2)], "model_name string, version int")
    plan = model_registry.promotion_plan(versions, replies.withColumn("version", F.lit(2)))
    got = {(r["model_name"], r["version"]): r["action"] for r in plan.collect()}
    assert got == {
        ("whole", 2): "promote", ("whole", 1): "retire", ("partial", 2): "abort", ("partial", 1): "keep",
        ("untried", 2): "abort", ("untried", 1): "keep",
    }


def test_registered_versions(spark, tmp_path):
    path = str(tmp_path / "models")
    entry = spark.sql("SELECT 'm/1' AS model_name, CAST(4 AS BIGINT) AS version, map('a', 'b') AS tags, 0.5D AS metric")
    assert [model_registry.append_registry(entry, path) for _ in range(2)] == [4, 5]
    rows = model_registry.read_registry(spark, path, entry.schema).orderBy("version").collect()
    assert [(r["model_name"], r["version"], r["tags"], r["metric"]) for r in rows] == [("m/1", v, {"a": "b"}, 0.5) for v in (4, 5)]


def test_replies_by_several_maps_score_texts_once(spark, monkeypatch):
    """The gate on two label maps reads the texts through the model once."""
    from reviewloom.operators import bayes
    from reviewloom.queries import queries

    calls = []
    predict = bayes.predict
    monkeypatch.setattr(bayes, "predict", lambda *a, **k: calls.append(1) or predict(*a, **k))
    assert queries()["promotion_replies"](spark, "/root/testdata/sf0.001").count() == 4
    assert len(calls) == 1
