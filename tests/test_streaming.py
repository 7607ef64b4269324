import datetime as dt
import time

from pyspark.sql import functions as F

from reviewloom.functions.metric_names import device_of, normal_key, normal_value
from reviewloom.streaming import jobs
from reviewloom.streaming.sink import run_available, stream_table
from reviewloom.streaming.utilisation import utilisation_rows, window_means

START = dt.datetime(2024, 1, 1)


def _samples(spark, tmp_path, files=3):
    keys = [
        "m/gpu:0/util (%)/mean", "m/gpu:0/memory_used (MiB)/mean", "m/gpu:1/util (%)/mean", "m/host/cpu (%)/mean",
        "m/gpu:0/fan_speed (%)/mean", "m/host/load_average (%)/mean", "m/gpu:0/util (%)/max", "m/pid/cpu (%)/mean",
        "m/gpu:0/temperature (C)/mean",
    ]
    rows = [(START + dt.timedelta(seconds=i), keys[i % len(keys)], float(i % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, key string, value double")
    for n in range(files):
        df.filter(F.pmod(F.hash("ts"), F.lit(files)) == n).write.mode("append").parquet(str(tmp_path / "in"))
    return df


def test_stream_means_equal_batch_means(spark, tmp_path):
    df = _samples(spark, tmp_path)
    stream = stream_table(spark, str(tmp_path / "in"), files_per_trigger=2)
    got = jobs.stream_window_means(stream)
    want = window_means(df)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_best_so_far_over_several_batches(spark, tmp_path):
    rows = [("hot" if i % 3 else f"r{i % 4}", i, float((i * 37) % 50)) for i in range(120)] + [("hot", 500, float("nan"))]
    df = spark.createDataFrame(rows, "run_id string, seq int, value double")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    got = jobs.stream_best(stream_table(spark, str(tmp_path / "in"), files_per_trigger=1))
    assert sorted(got.select("run_id", "best", "best_seq").collect()) == sorted(jobs.best_so_far(df).collect())


def test_a_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    from reviewloom.streaming.sink import epoch_writer

    write = epoch_writer(str(tmp_path / "out"))
    for _ in range(2):
        write(spark.range(4).toDF("k"), 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_metric_log_stream(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("run_id"), F.lit("m").alias("name"))
    df.write.parquet(str(tmp_path / "in"))
    assert sorted(jobs.stream_metric_log(stream_table(spark, str(tmp_path / "in"))).collect()) == sorted(df.collect())


def test_appended_rows_carry_their_epoch(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "in"))
    stream = stream_table(spark, str(tmp_path / "in"), files_per_trigger=1)
    written = run_available(stream, "copy", stream.schema, "append")
    assert sorted(r["id"] for r in written.collect()) == list(range(10))
    assert written.select("epoch").distinct().count() == 2


def test_rows_per_device(spark, tmp_path):
    rows = utilisation_rows(window_means(_samples(spark, tmp_path))).collect()
    families = {(r["device"], r["family"]) for r in rows}
    assert families == {
        ("/gpu:0/", "utilization"), ("/gpu:0/", "memory"), ("/gpu:0/", "other"), ("/gpu:1/", "utilization"), ("host", "utilization"),
    }
    assert all(list(r["metrics"]) == sorted(r["metrics"]) for r in rows)


def test_key_functions(spark):
    keys = spark.createDataFrame([("a/gpu:12/util (%)/mean",), ("gpu total (MiB)/mean",), ("b/host/x",)], "k string")
    rows = keys.select(normal_key(F.col("k")).alias("n")).select("n", device_of(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [("a/gpu:12/util %", "/gpu:12/"), ("gpu", "host"), ("b/host/x", "host")]
    values = spark.createDataFrame([(0.125,), (2.5,), (None,), (0.0,)], "v double")
    assert [r[0] for r in values.select(normal_value(F.col("v"))).collect()] == [0.12, 2.5, 0.0, 0.0]


def test_late_files_count(spark, tmp_path):
    for hours in (4, 2, 0):  # the newest first
        start = START + dt.timedelta(hours=hours)
        rows = [(start + dt.timedelta(seconds=i), "m/gpu:0/util (%)/mean", float(i)) for i in range(50)]
        part = spark.createDataFrame(rows, "ts timestamp, key string, value double").coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken by modification time
    got = jobs.stream_window_means(stream_table(spark, str(tmp_path / "in"), files_per_trigger=1))
    want = window_means(spark.read.parquet(str(tmp_path / "in")))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert got.agg({"n": "sum"}).first()[0] == 150
