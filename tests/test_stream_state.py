"""Streams with state of their own, against their batch forms, over batches and restarts."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import runs as ra
from reviewloom.streaming import jobs, partials
from reviewloom.streaming.sink import stream_table
from reviewloom.streaming.utilisation import window_means

START = dt.datetime(2024, 1, 1)


def _reports(spark, path, rows):
    """Appends a file of (experiment, run_id, seq, value); time follows the number."""
    shown = [(e, r, START + dt.timedelta(seconds=n), n, v) for e, r, n, v in rows]
    frame = spark.createDataFrame(shown, "experiment string, run_id string, ts timestamp, seq int, value double")
    frame.coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # files are taken by modification time
    return frame


def _batch_stops(frame, goal="max"):
    out = {}
    for (name,) in frame.select("experiment").distinct().collect():
        own = frame.filter(F.col("experiment") == name)
        curve = ra.numbered_intervals(own.select("run_id", "ts", "seq", "value"), [F.col("ts"), F.col("seq")])
        out.update({(name, r["run_id"]): r["stopped_at"] for r in ra.bandit_stops(curve, goal=goal).collect()})
    return out


@pytest.mark.parametrize("goal", ["max", "min"])
def test_stops_equal_the_batch_decisions(spark, tmp_path, goal):
    rng = random.Random(5)
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    seen, emitted = [], []
    n = 0
    for _ in range(3):  # every file holds the next five reports of every run
        rows = []
        for _ in range(5):
            for experiment, run in (("a", "p"), ("a", "q"), ("a", "r"), ("b", "p"), ("b", "s")):
                value = None if rng.random() < 0.1 else round(rng.uniform(1, 2) * (2 if run == "q" else 1), 3)
                rows.append((experiment, run, n, value))
                n += 1
        seen.append(_reports(spark, path, rows))
        got = jobs.stream_stops(stream_table(spark, path), checkpoint=state, goal=goal).collect()
        emitted += [(r["experiment"], r["run_id"], r["stopped_at"]) for r in got]
    everything = seen[0].unionByName(seen[1]).unionByName(seen[2])
    want = _batch_stops(everything, goal)
    assert want and len(emitted) == len(want) and {(e, r): s for e, r, s in emitted} == want
    # A restart without new reports emits nothing, and one with reports of stopped runs no second stop.
    assert jobs.stream_stops(stream_table(spark, path), checkpoint=state, goal=goal).collect() == []
    _reports(spark, path, [(e, r, n + k, 1.5) for k, (e, r) in enumerate(want)])
    assert jobs.stream_stops(stream_table(spark, path), checkpoint=state, goal=goal).collect() == []


def test_idle_experiments_are_forgotten(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    rows = [("a", run, 2 * n + k, value) for n in range(5) for k, (run, value) in enumerate((("p", 1.0), ("q", 9.0)))]
    policy = {"checkpoint": state, "idle_ms": 60_000}
    _reports(spark, path, rows)
    got = jobs.stream_stops(stream_table(spark, path), **policy).collect()
    assert [(r["run_id"], r["stopped_at"]) for r in got] == [("p", 5)]
    # Another experiment's reports move the watermark past the timer; the first one's runs then start anew.
    _reports(spark, path, [("z", "p", 400, 1.0)])
    assert jobs.stream_stops(stream_table(spark, path), **policy).collect() == []
    _reports(spark, path, [(e, r, 500 + n, v) for e, r, n, v in rows])
    again = jobs.stream_stops(stream_table(spark, path), **policy).collect()
    assert [(r["run_id"], r["stopped_at"]) for r in again] == [("p", 5)]


def _samples(spark, hours, n=40):
    start = START + dt.timedelta(hours=hours)
    rows = [(start + dt.timedelta(seconds=i), f"m/gpu:{i % 2}/util (%)/mean", float(i * 7 % 13)) for i in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, key string, value double").coalesce(1)


def test_late_samples_correct_closed_windows(spark, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    published = {}
    for hours, late in ((0, 0), (4, 0), (2, 40), (0, 40)):
        _samples(spark, hours).write.mode("append").parquet(path)
        partials.run_partials(stream_table(spark, path), out, state, 60)
        got = {tuple(r[c] for c in partials.KEYS): r for r in partials.closed_means(spark, out, 60).collect()}
        # What was published once stays as it was.
        assert all(got[k] == r for k, r in published.items())
        published = got
        newest = partials.sums(spark, out).agg(F.max("epoch")).first()[0]
        assert (partials.sums(spark, out).filter(F.col("late") & (F.col("epoch") == newest)).agg(F.sum("n")).first()[0] or 0) == late
    want = window_means(spark.read.parquet(path))
    merged = partials.merged_means(spark, out)
    assert sorted(merged.select(want.columns).collect()) == sorted(want.collect())
    fixed = partials.corrections(spark, out).collect()
    assert sum(r["n_late"] for r in fixed) == 80 and all(r["n"] >= r["n_late"] for r in fixed)


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    out = str(tmp_path / "out")
    write = partials.write_batch(out, 60)
    for epoch, hours in ((0, 1), (1, 0), (0, 1), (1, 0)):
        write(_samples(spark, hours), epoch)
    assert partials.merged_means(spark, out).agg(F.sum("n")).first()[0] == 80
    assert {r["late"] for r in partials.sums(spark, out).filter("epoch = 1").collect()} == {True}
