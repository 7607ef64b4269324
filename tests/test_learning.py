import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import NaiveBayes as LibraryBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from reviewloom.functions.tokens import words
from reviewloom.operators import bayes, centroid_blocks, centroids, sweep, vocabulary
from reviewloom.operators.scoring import map_text
from reviewloom.plans import limits
from reviewloom.plans.storage import materialise

WORDS = ["good", "bad", "fine", "poor", "the", "a", "!", "café", "naïve", "x1"]


def _texts(n, seed=0):
    rng = random.Random(seed)
    return [
        (i, " ".join(rng.choices(WORDS, [8 if "g" in w and y else 3 for w in WORDS], k=rng.randrange(0, 15))), y)
        for i in range(n)
        for y in [int(rng.random() < 0.7)]
    ]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, text string, y int")


@pytest.mark.parametrize("large", [False, True])
def test_naive_bayes_matches_the_library(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    train, test = _frame(spark, _texts(120)), _frame(spark, _texts(40, 1))
    got = bayes.predict(test, "k", "text", bayes.train(train, "text", "y", 0.5)).collect()
    counted = lambda df: df.withColumn("w", words(F.col("text")))
    vectors = CountVectorizer(inputCol="w", outputCol="features").fit(counted(train))
    model = LibraryBayes(smoothing=0.5, labelCol="y").fit(vectors.transform(counted(train)))
    want = {r["k"]: r for r in model.transform(vectors.transform(counted(test))).collect()}
    assert len(got) == 40
    for row in got:
        # The library smooths the class prior too, so only differences between documents agree.
        assert row["pred"] == int(want[row["k"]]["prediction"]) or abs(row["scores"][0] - row["scores"][1]) < 0.05
    shift = [r["scores"][1] - r["scores"][0] - (want[r["k"]]["rawPrediction"][1] - want[r["k"]]["rawPrediction"][0]) for r in got]
    assert max(shift) - min(shift) < 1e-9


def test_document_without_known_words_keeps_the_prior(spark):
    model = bayes.train(_frame(spark, [(1, "good", 1), (2, "good fine", 1), (3, "bad", 0)]), "text", "y")
    rows = bayes.predict(_frame(spark, [(7, "zzz", 0), (8, "", 0), (9, None, 0)]), "k", "text", model).collect()
    assert {r["k"]: r["pred"] for r in rows} == {7: 1, 8: 1, 9: 1}
    assert all(math.isclose(r["scores"][0], math.log(1 / 3)) for r in rows)


def test_class_without_words_is_counted(spark):
    model = bayes.train(_frame(spark, [(1, "a b", 0), (2, "", 1), (3, "", 1)]), "text", "y")
    assert model.classes == [(0, 1, 2), (1, 2, 0)] and model.vocabulary == 2


def test_one_pass_trials_match_single_models(spark):
    train, val = _frame(spark, _texts(100)), _frame(spark, _texts(50, 2))
    model = bayes.train(train, "text", "y")
    trials = [
        {"trial_id": 0, "alpha": 1.0, "vocab_size": 0, "uniform_prior": 0},
        {"trial_id": 1, "alpha": 0.1, "vocab_size": 0, "uniform_prior": 0},
        {"trial_id": 2, "alpha": 0.1, "vocab_size": 3, "uniform_prior": 1},
    ]
    rows = {r["trial_id"]: r for r in bayes.score_trials(val, "k", "text", "y", model, trials).collect()}
    for trial in trials[:2]:
        judged = bayes.predict(val, "k", "text", model.with_alpha(trial["alpha"]), ["y"])
        hits = judged.agg(F.avg((F.col("y") == F.col("pred")).cast("double"))).first()[0]
        assert math.isclose(rows[trial["trial_id"]]["accuracy"], hits)
    counts = {y: Counter() for y in (0, 1)}
    for _, text, y in _texts(100):
        counts[y].update(text.split())
    total = counts[0] + counts[1]
    kept = sorted(total, key=lambda w: (-total[w], w))[:3]
    sums = {y: sum(counts[y][w] for w in kept) for y in counts}
    right = 0
    for _, text, y in _texts(50, 2):
        score = [sum(math.log((counts[c][w] + 0.1) / (sums[c] + 0.3)) for w in text.split() if w in kept) for c in (0, 1)]
        right += (0 if score[0] >= score[1] else 1) == y
    assert math.isclose(rows[2]["accuracy"], right / 50)


def test_search_marks_the_earliest_best_trial(spark):
    train, val = _frame(spark, _texts(100)), _frame(spark, _texts(50, 2))
    trials = [{"trial_id": i, "alpha": a, "vocab_size": 0, "uniform_prior": 0} for i, a in enumerate((50.0, 0.5, 0.5))]
    model = bayes.train(train, "text", "y")
    rows = sweep.search(model, val, "k", "text", "y", trials, "accuracy").orderBy("trial_id").collect()
    best = max(r["accuracy"] for r in rows)
    assert [r["is_best"] for r in rows].index(True) == [r["accuracy"] for r in rows].index(best)
    assert sum(r["is_best"] for r in rows) == 1
    assert all(math.isclose(r["recall"], r["auc_weighted"]) for r in rows)


@pytest.mark.parametrize("large", [False, True])
def test_token_ids_keep_whole_rows(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    rows = _texts(30)
    df = _frame(spark, rows)
    vocab = {r["token"]: r["id"] for r in vocabulary.build_vocabulary(df, "text", 4).collect()}
    total = Counter(w for _, t, _ in rows for w in re.findall(r"[^\W_]+|[^\w\s]", t))
    assert [vocab[w] for w in sorted(total, key=lambda w: (-total[w], w))[:4]] == [4, 5, 6, 7] and len(vocab) == 8
    ids = vocabulary.token_ids(df, "k", "text", vocabulary.build_vocabulary(df, "text", 4), max_length=8).collect()
    want = {k: [2] + [vocab.get(w, 1) for w in re.findall(r"[^\W_]+|[^\w\s]", t)][:6] + [3] for k, t, _ in rows}
    assert {r["k"]: r["input_ids"] for r in ids} == want
    assert all(r["attention_mask"] == [1] * len(r["input_ids"]) for r in ids)


def test_sketched_vocabulary_is_the_counted_one(spark):
    rng = random.Random(4)
    names = [f"t{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choices(names, [1 / (j + 1) for j in range(400)], k=60))) for k in range(300)]
    df = spark.createDataFrame(rows, "k bigint, text string")
    want = sorted(vocabulary.build_vocabulary(df, "text", 10).collect())
    assert vocabulary.frequent_counts(df, "text", 10, 5000) is not None
    assert sorted(vocabulary.build_vocabulary(df, "text", 10, tracked=5000).collect()) == want
    # A small sketch, more tokens than there are, or ties prove nothing; then every token is counted.
    ties = spark.createDataFrame([(k, f"a{k} b{k}") for k in range(50)], "k bigint, text string")
    for rows, size, tracked in ((df, 10, 16), (df, 500, 5000), (df, 300, 5000), (ties, 7, 20), (df.limit(0), 3, 100)):
        assert vocabulary.frequent_counts(rows, "text", size, tracked) is None or size == 300
        got = vocabulary.build_vocabulary(rows, "text", size, tracked=tracked).collect()
        assert sorted(got) == sorted(vocabulary.build_vocabulary(rows, "text", size).collect())


@pytest.mark.parametrize("large", [False, True])
def test_padded_batches_in_one_shuffle(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    df = _frame(spark, _texts(21) + [(100, "", 0), (101, None, 0)])
    vocab = materialise(vocabulary.build_vocabulary(df, "text", 6))
    ids = vocabulary.token_ids(df, "k", "text", vocab, max_length=9)
    want = vocabulary.pad_batches(vocabulary.mini_batches(ids, "k", 8)).select("k", "batch_id", "input_ids", "attention_mask")
    got = vocabulary.padded_batches(df, "k", "text", vocab, 8, max_length=9)
    with_text = {r["k"] for r in ids.collect()}
    batch_of = {r["k"]: r["batch_id"] for r in vocabulary.mini_batches(df.select("k"), "k", 8).collect()}
    rows = got.collect()
    assert {r["k"] for r in rows} == with_text and all(r["batch_id"] == batch_of[r["k"]] for r in rows)
    if len(with_text) == df.count():
        assert sorted(map(tuple, rows)) == sorted(map(tuple, want.collect()))
    plain = {r["k"]: (r["input_ids"], r["attention_mask"]) for r in ids.collect()}
    longest = {b: max(len(plain[r["k"]][0]) for r in rows if r["batch_id"] == b) for b in set(batch_of.values())}
    for r in rows:
        own, mask = plain[r["k"]]
        gap = longest[r["batch_id"]] - len(own)
        assert r["input_ids"] == own + [0] * gap and r["attention_mask"] == mask + [0] * gap


def test_batches_are_padded_to_their_longest(spark):
    df = _frame(spark, _texts(21))
    ids = vocabulary.token_ids(df, "k", "text", vocabulary.build_vocabulary(df, "text", 50))
    padded = vocabulary.pad_batches(vocabulary.mini_batches(ids, "k", 8)).collect()
    sizes = Counter(r["batch_id"] for r in padded)
    assert sizes == {0: 8, 1: 8, 2: 5}
    for batch in sizes:
        rows = [r for r in padded if r["batch_id"] == batch]
        assert len({len(r["input_ids"]) for r in rows}) == 1
        assert max(sum(r["attention_mask"]) for r in rows) == len(rows[0]["input_ids"])


def test_vocabulary_grows_by_new_tokens_only(spark):
    vocab = spark.createDataFrame([("[PAD]", 0), ("a", 4)], "token string, id bigint")
    more = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "token string")
    rows = {r["token"]: r["id"] for r in vocabulary.extend_vocabulary(vocab, more).collect()}
    assert rows["a"] == 4 and sorted([rows["b"], rows["c"]]) == [5, 6] and len(rows) == 4
    assert vocabulary.extend_vocabulary(vocab, more.limit(0)).count() == 2


def test_nearest_centroid(spark):
    rows = [(0, [0.0, 0.0]), (0, [0.0, 2.0]), (1, [10.0, 0.0]), (1, [10.0, 2.0])]
    df = spark.createDataFrame(rows, "y int, v array<float>")
    means = centroids.fit_centroids(df, "v", "y")
    got = centroids.predict_centroid(spark.createDataFrame([(1, [4.9, 1.0]), (2, [5.0, 1.0]), (3, [9.0, 1.0])], "k int, v array<float>"), "v", means, ["k"])
    assert {r["k"]: r["pred"] for r in got.collect()} == {1: 0, 2: 0, 3: 1}


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_nearest_centroid_in_blocks_equals_the_one_copy(spark, monkeypatch, spread):
    generator = np.random.default_rng(3)
    centres = generator.normal(size=(20, 6))
    means = np.vstack([centres[i % 20] + spread * generator.normal(size=6) for i in range(900)])
    means[7] = means[450]  # a tie between two labels
    points = np.vstack([means[generator.integers(900, size=300)] + 0.01, means[[7] * 400]])
    model = spark.createDataFrame([(f"c{i:04d}", m.tolist()) for i, m in enumerate(means)], "label string, centroid array<double>")
    rows = spark.createDataFrame([(i, i % 3, p.tolist()) for i, p in enumerate(points)], "k long, pred_in int, v array<double>")
    whole = centroids.predict_centroid(rows, "v", model, ["k", "pred_in"]).orderBy("k").collect()
    for name, value in (("BLOCK_ROWS", 16), ("PIVOTS", 8), ("BATCH_ROWS", 32), ("BATCHES_A_TASK", 2)):
        monkeypatch.setattr(centroid_blocks, name, value)
    monkeypatch.setattr(limits, "SMALL_ROWS", 100)
    got = centroids.predict_centroid(rows, "v", model, ["k", "pred_in"]).orderBy("k").collect()
    assert got == whole
    assert {r["pred"] for r in got[300:]} == {"c0007"}
    brute = [((points[i] - means) ** 2).sum(axis=1).argmin() for i in range(len(points))]
    assert [r["pred"] for r in got] == [f"c{i:04d}" for i in brute]


def test_blocks_away_from_a_row_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr(centroid_blocks, "BLOCK_ROWS", 4)
    known = pd.DataFrame([(0, 0, 0.0, 1.0), (256, 0, 5.0, 9.0), (1, 1, 0.0, 2.0)], columns=["block", "pivot", "near", "far"])
    rows = spark.createDataFrame([(0, [0.5, 0.0]), (1, [99.0, 0.0])], "__row long, v array<double>")
    visits = centroid_blocks._visits(rows, "v", np.array([[0.0, 0.0], [100.0, 0.0]]), known).collect()
    assert {(v["block"], i) for v in visits for i in np.frombuffer(v["ids"], "int64")} == {(0, 0), (1, 1)}


def test_user_function_over_batches(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    got = map_text(df, lambda frame: frame.assign(double=frame["k"] * 2), "k bigint, double bigint")
    assert sorted(tuple(r) for r in got.collect()) == [(i, 2 * i) for i in range(10)]


def test_prediction_stores_no_row_a_token(spark, monkeypatch):
    """With a vocabulary beyond the broadcast, what a prediction stores grows with documents and rare tokens only."""
    rows = [(i, f"good good bad bad the the rare{i}", i % 2) for i in range(60)] + [(60, "new new", 0), (61, "", 1), (62, None, 1)]
    frame = _frame(spark, rows)
    whole = bayes.train(frame, "text", "y").prepared()
    want = {r["k"]: r for r in bayes.predict(frame, "k", "text", whole).collect()}
    monkeypatch.setattr(limits, "BROADCAST_ROWS", 5)
    stored = []

    def counted(df):
        kept = materialise(df)
        stored.append(kept.count())
        return kept

    for module in ("reviewloom.operators.bayes", "reviewloom.plans.joins"):
        monkeypatch.setattr(f"{module}.materialise", counted)
    got = bayes.predict(frame, "k", "text", whole).collect()
    assert len(got) == len(rows) and all(r["scores"] == pytest.approx(want[r["k"]]["scores"]) and r["pred"] == want[r["k"]]["pred"] for r in got)
    assert stored and max(stored) <= 2 * len(rows)
