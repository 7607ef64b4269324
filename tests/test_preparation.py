import math
import statistics

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.labels import argmax, cross_entropy
from reviewloom.functions.metric_names import logged_value
from reviewloom.operators import encoding, preparation
from reviewloom.plans import quantiles

NAN = float("nan")


def test_rating_edges(spark):
    ratings = [1.0, 2.0, 2.99, 3.0, 3.99, 4.0, 5.0, NAN, None]
    df = spark.createDataFrame(list(enumerate(ratings)), "i int, overall double")
    rows = preparation.label_by_threshold(df, "overall").orderBy("i").collect()
    assert [r["sentiment"] for r in rows] == [0.0, 0.0, 0.0, None, None, 1.0, 1.0, None, None]


def test_complete_rows_keeps_empty_text(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("", 0.0, "x"), (None, 1.0, "x"), ("b", NAN, "x")], "t string, y double, z string"
    )
    assert [r["t"] for r in preparation.complete_rows(df, ["t", "y"]).collect()] == ["a", ""]


def test_distinct_counts_missing_once(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,), (1.0,)], "y double")
    assert preparation.distinct_with_missing(df, "y").first()[0] == 2
    assert preparation.distinct_with_missing(df.filter("y = 1"), "y").first()[0] == 1


def test_quartiles_interpolate_and_skip_nan(spark):
    df = spark.createDataFrame([(v,) for v in (4.0, 1.0, NAN, 3.0, None, 2.0)], "x double")
    row = preparation.describe(df, ["x"]).first()
    assert (row["n"], row["min"], row["max"]) == (4, 1.0, 4.0)
    assert (row["p25"], row["p50"], row["p75"]) == (1.75, 2.5, 3.25)
    assert math.isclose(row["std"], statistics.stdev([1, 2, 3, 4]))


def test_quartiles_of_one_dominant_value(spark):
    values = [5.0] * 700 + [float(i) for i in range(1000, 1300)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    row = preparation.describe(df, ["x"]).first()
    exact = statistics.quantiles(values, n=4, method="inclusive")
    assert [row["p25"], row["p50"], row["p75"]] == exact


def test_approximate_quartiles_are_close(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("x"))
    row = preparation.describe(df, ["x"], approx=True).first()
    assert abs(row["p50"] - 501) <= 1


def test_argmax_takes_first_maximum_and_nan(spark):
    df = spark.createDataFrame([(0, [0.1, 0.9, 0.9]), (1, [0.1, NAN, 5.0])], "i int, a array<double>")
    rows = df.select("i", argmax(F.col("a")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in rows] == [1, 1]


def test_cross_entropy_of_large_logits(spark):
    df = spark.createDataFrame([([1000.0, 0.0], 0), ([0.0, 0.0], 1)], "z array<double>, y int")
    loss = [r[0] for r in df.select(cross_entropy(F.col("z"), F.col("y"))).collect()]
    assert loss[0] == 0.0 and math.isclose(loss[1], math.log(2))


def test_logged_text_that_is_no_number(spark):
    df = spark.createDataFrame([("0.5",), ("abc",), (None,)], "v string")
    assert [r[0] for r in df.select(logged_value(F.col("v"))).collect()] == [0.5, None, None]


def test_numeric_labels_sort_as_numbers(spark):
    df = spark.createDataFrame([(10.0,), (2.0,), (1.0,), (2.0,), (None,)], "y double")
    rows = {r["label"]: r["idx"] for r in encoding.fit_label_map(df, "y").collect()}
    assert rows == {1.0: 0, 2.0: 1, 10.0: 2}


@pytest.mark.parametrize("large", [False, True])
def test_encode_decode_round_trip(spark, large, request):
    if large:
        request.getfixturevalue("tiny_limits")
    rows = [(i, "hot" if i % 3 else f"v{i % 7}") for i in range(90)] + [(90, None)]
    df = spark.createDataFrame(rows, "i int, y string")
    label_map = encoding.fit_label_map(df, "y")
    coded = encoding.encode_labels(df, label_map, "y")
    back = encoding.decode_labels(coded, label_map, "labels", "again")
    assert sorted((r["i"], r["again"]) for r in back.collect()) == rows


def test_unknown_label(spark):
    label_map = encoding.fit_label_map(spark.createDataFrame([("a",), ("b",)], "y string"), "y")
    other = spark.createDataFrame([("a",), ("c",)], "y string")
    with pytest.raises(ValueError):
        encoding.encode_labels(other, label_map, "y")
    kept = encoding.encode_labels(other, label_map, "y", invalid="keep").collect()
    assert sorted((r["y"], r["labels"]) for r in kept) == [("a", 0), ("c", None)]
    assert encoding.encode_labels(other, label_map, "y", invalid="skip").count() == 1


def test_target_list_is_first_seen(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (4, "a")], "i int, y string")
    rows = encoding.target_list(df, "y", "i").orderBy("position").collect()
    assert [r["label"] for r in rows] == ["c", "b", "a"]


def test_describe_keeps_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (3.0, None, None)], "a double, b double, c double")
    rows = {r["column_name"]: r for r in preparation.describe(df, ["a", "b", "c"]).collect()}
    assert {c: r["n"] for c, r in rows.items()} == {"a": 2, "b": 0, "c": 0}
    assert rows["a"]["p50"] == 2.0 and rows["b"]["p50"] is None and rows["c"]["max"] is None


def _exact(values):
    return statistics.quantiles(values, n=4, method="inclusive")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 999, 4001])
def test_quartiles_of_any_size(spark, n):
    values = [float((i * 7919) % 1009) - 300.5 for i in range(n)]
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double").repartition(3)
    rows = {r["column_name"]: r for r in preparation.describe(df, ["x", "y"]).collect()}
    exact = _exact(values) if n > 1 else values * 3
    assert [rows["x"][p] for p in ("p25", "p50", "p75")] == pytest.approx(exact)
    assert [rows["y"][p] for p in ("p25", "p50", "p75")] == pytest.approx([-v for v in reversed(exact)])


def test_quartiles_at_infinite_values(spark):
    values = [float("-inf")] * 3 + [1.0, 2.0, 3.0] + [float("inf")] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = preparation.describe(df, ["x"]).first()
    assert [row["p25"], row["p50"], row["p75"]] == [float("-inf"), 2.0, float("inf")]


@pytest.mark.parametrize("spread, accuracy", [(0.0, 10), (0.0, 1), (0.2, 10_000)])
def test_quartiles_without_a_proof_are_counted_again(spark, monkeypatch, spread, accuracy):
    monkeypatch.setattr(quantiles, "SPREAD", spread)
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    df = spark.range(2000).select(((F.col("id") * 37) % 2003).cast("double").alias("x"))
    row = preparation.describe(df, ["x"]).first()
    values = [float(i * 37 % 2003) for i in range(2000)]
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(_exact(values))


def test_only_bracketed_values_are_counted_one_by_one(spark):
    values = spark.range(100_000).select(F.lit("x").alias("c"), F.col("id").cast("double").alias("v"))
    bracketed = values.withColumn("__low0", F.lit(499.0)).withColumn("__high0", F.lit(502.0))
    rows = quantiles._counted(bracketed, "c", "v", 1).collect()
    inside = {r["v"]: r["__copies"] for r in rows if r["__inside"]}
    assert inside == {499.0: 1, 500.0: 1, 501.0: 1, 502.0: 1}
    assert sorted(r["__copies"] for r in rows if not r["__inside"]) == [499, 99_497]
