import pytest
from pyspark.sql import functions as F

from reviewloom.operators import model_registry as mr
from reviewloom.operators import runs as ra
from reviewloom.operators import sweep

NAN = float("nan")


def _runs(spark, rows):
    return spark.createDataFrame(rows, "run_id string, parent_id string, name string, seq int")


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "run_id string, name string, seq int, value double")


@pytest.fixture
def family(spark):
    return _runs(spark, [("a", "p", "A", 1), ("b", "p", "B", 2), ("c", "p", "C", 3), ("d", "q", "D", 4)])


def test_first_logged_value_is_the_score(spark, family):
    values = [("a", "test_val", i, float(v)) for i, v in enumerate([1, 5, 9, 4, 12])]
    metrics = _metrics(spark, values + [("b", "test_val", 0, 1.5)])
    assert ra.best_run(family, metrics, "test_val").first()["run_id"] == "b"


def test_best_run_ties_and_nan(spark, family):
    rows = [("b", "m", 0, 0.9), ("a", "m", 0, 0.9), ("c", "m", 0, NAN), ("d", "m", 0, None)]
    metrics = _metrics(spark, rows)
    assert ra.best_run(family, metrics, "m").first()["run_id"] == "a"
    assert ra.best_run(family, metrics, "m", goal="min").first()["run_id"] == "a"
    assert ra.best_value(metrics, "m").first()[0] == 0.9
    assert ra.best_run(family, metrics, "other").collect() == []
    assert tuple(ra.run_counts(family, metrics, "m").first()) == (4, 4)


def test_best_child_per_parent(spark, family):
    metrics = _metrics(spark, [("a", "m", 0, 0.5), ("b", "m", 0, 0.5), ("c", "m", 0, 0.4), ("d", "m", 0, 0.1)])
    best = {r["parent_id"]: r["run_id"] for r in ra.best_child(family, metrics, "m").collect()}
    assert best == {"p": "a", "q": "d"}
    worst = {r["parent_id"]: r["run_id"] for r in ra.best_child(family, metrics, "m", "min").collect()}
    assert worst == {"p": "c", "q": "d"}


@pytest.mark.parametrize("large", [False, True])
def test_deep_and_wide_tree(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    chain = [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 12)]
    wide = [(f"w{i}", "n5") for i in range(60)]
    lost = [("x1", "nowhere"), ("x2", "x1")]
    rows = [(r, p, "run", i) for i, (r, p) in enumerate(chain + wide + [("alone", None)] + lost)]
    got = {r["run_id"]: (r["root_id"], r["depth"]) for r in ra.flatten_runs(_runs(spark, rows)).collect()}
    want = {f"n{i}": ("n0", i) for i in range(12)} | {f"w{i}": ("n0", 6) for i in range(60)}
    assert got == want | {"alone": ("alone", 0)}


def test_cycles_have_no_root(spark):
    rows = _runs(spark, [("a", "b", "A", 1), ("b", "a", "B", 2), ("c", "a", "C", 3), ("r", None, "R", 4), ("s", "r", "S", 5), ("t", "s", "T", 6)])
    flat = ra.flatten_runs(rows)
    assert sorted(map(tuple, flat.collect())) == [("r", "r", 0), ("s", "r", 1), ("t", "r", 2)]
    assert sorted(r["run_id"] for r in ra.unreached_runs(rows, flat).collect()) == ["a", "b", "c"]


def test_lookups(spark, family):
    assert ra.run_by_id_part(family, "").first()["run_id"] == "a"
    assert ra.run_by_id_part(family, "c").first()["run_id"] == "c"
    assert ra.run_by_name(family, "D").first()["run_id"] == "d"
    with pytest.raises(Exception, match="no run is named none"):
        ra.run_by_name(family, "none").collect()


def test_family_winner_is_redirected(spark):
    runs = _runs(spark, [("s", "p", "AutoML_Classification", 1), ("t", "s", "Test_AutoML_Best_Model", 2), ("w", "p", "Sweep", 3)])
    winner = ra.redirect_family(runs.filter("run_id = 't'"), runs).first()
    assert winner["is_automl"] and winner["source_run_id"] == "s"
    other = ra.redirect_family(runs.filter("run_id = 'w'"), runs).first()
    assert not other["is_automl"] and other["source_run_id"] == "w"


def test_lineage_takes_the_last(spark):
    rows = [("r", "train_set", 1, 5), ("r", "train_set", 2, 3), ("r", "val_set", 1, 7), ("r", "junk", 9, 9)]
    df = spark.createDataFrame(rows, "run_id string, name string, seq int, version int")
    row = ra.lineage(df).first()
    assert (row["train_version"], row["val_version"], row["test_version"]) == (3, 7, None)


def test_bandit_slack(spark):
    rows = [(run, i, v if i == 5 else 0.1) for run, v in (("a", 0.80), ("b", 0.73), ("c", 0.72)) for i in range(1, 8)]
    curve = spark.createDataFrame(rows, "run_id string, interval_no bigint, value double")
    assert [tuple(r) for r in ra.bandit_stops(curve).collect()] == [("c", 5)]


def test_bandit_minimises(spark):
    rows = [("a", 5, 1.0), ("b", 5, 1.09), ("c", 5, 1.2)]
    curve = spark.createDataFrame(rows, "run_id string, interval_no bigint, value double")
    assert [tuple(r) for r in ra.bandit_stops(curve, goal="min").collect()] == [("c", 5)]


def test_best_checkpoint_prefers_the_earlier(spark):
    df = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.3), ("r", 3, 0.3), ("r", 0, NAN)], "run_id string, epoch int, loss double")
    assert tuple(ra.best_checkpoint(df).first()) == ("r", 2, 0.3)


def test_registry(spark):
    rows = [("m", 1, "x"), ("m", 3, "y"), ("m", 2, "z"), ("k", 1, "u")]
    registry = spark.createDataFrame(rows, "model_name string, version int, run_id string")
    assert {r["model_name"]: r["run_id"] for r in mr.latest_versions(registry).collect()} == {"m": "y", "k": "u"}
    assert sorted(r["version"] for r in mr.old_versions(registry).collect()) == [1, 2]
    assert mr.next_version(registry, "m") == 4 and mr.next_version(registry, "new") == 1


def test_promotion(spark):
    registry = spark.createDataFrame([(m, v) for m in ("good", "bad", "mute") for v in (1, 2)], "model_name string, version int")
    smoke = spark.createDataFrame([("good", 2, 2, 2), ("bad", 2, 2, 1), ("bad", 1, 2, 2)], "model_name string, version int, n_valid int, n_replies int")
    plan = {(r["model_name"], r["version"]): (r["action"], r["traffic"]) for r in mr.promotion_plan(registry, smoke).collect()}
    assert plan == {
        ("good", 2): ("promote", 100), ("good", 1): ("retire", None), ("bad", 2): ("abort", None),
        ("bad", 1): ("keep", None), ("mute", 2): ("abort", None), ("mute", 1): ("keep", None),
    }


def test_sampled_trials(spark):
    one = spark.createDataFrame([("e",)], "k string")
    trials = sweep.sample_trials(one, "k", sweep.DEFAULT_SPACE, 400, seed=2)
    rates = [r["learning_rate"] for r in trials.collect()]
    assert set(rates) == set(sweep.LEARNING_RATES)
    assert 70 < rates.count(5.5e-5) < 130
    assert trials.collect() == sweep.sample_trials(one, "k", sweep.DEFAULT_SPACE, 400, seed=2).collect()
    logs = sweep.sample_trials(one, "k", {"lr": sweep.LogUniform(-3, -1)}, 50).agg(F.min("lr"), F.max("lr")).first()
    assert 0.0497 < logs[0] < logs[1] < 0.3679


def test_grid_and_schedule(spark):
    one = spark.createDataFrame([("e",)], "k string")
    assert sweep.grid_trials(one, "k", sweep.DEFAULT_SPACE).count() == 7
    trials = spark.range(25).withColumnRenamed("id", "t")
    waves = sweep.schedule(trials, "t").groupBy("wave").count().orderBy("wave").collect()
    assert [r["count"] for r in waves] == [3, 3, 3, 3, 3, 3, 2]
