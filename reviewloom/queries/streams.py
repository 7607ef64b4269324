"""Structured Streaming jobs over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.plans.storage import scratch_path
from reviewloom.queries.base import query
from reviewloom.queries.learning import _ALL_SCORES, MODEL, trained_on_labels
from reviewloom.queries.views import VIEWS, requests, table, view_sql
from reviewloom.streaming import jobs, partials
from reviewloom.streaming.sink import stream_table
from reviewloom.streaming.utilisation import utilisation_rows

# Values have two decimals, so the SQL rounds exact sums of hundredths, half to even.
_MEANS = f"""{view_sql("v_samples")},
sums AS (SELECT (epoch(ts)::BIGINT // 5) * 5 AS window_start,
                 CASE WHEN contains(key, 'gpu') THEN regexp_extract(key, '/gpu:\\d+/') ELSE 'host' END AS device,
                 split_part(key, ' ', 1) || CASE WHEN contains(key, '%') THEN ' %' ELSE '' END AS name,
                 CASE WHEN contains(key, '%') THEN 'utilization' WHEN contains(key, 'memory') THEN 'memory'
                      ELSE 'other' END AS family,
                 sum(round(value * 100)::BIGINT)::BIGINT AS cents, count(*) AS n
          FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM v_samples)
          WHERE key NOT LIKE '%fan_speed%' GROUP BY ALL),
means AS (SELECT window_start, device, name, family, n,
                 (cents // n + CASE WHEN 2 * (cents % n) > n THEN 1 WHEN 2 * (cents % n) = n THEN (cents // n) % 2
                                    ELSE 0 END) / 100 AS mean FROM sums)"""


def _sample_stream(spark, sf_dir):
    events = stream_table(spark, f"{sf_dir}/events.parquet")
    return spark.sql(VIEWS["v_samples"], events=events)


@query("util_tumbling", f"WITH {_MEANS} SELECT window_start, device, name, mean, n FROM means")
def util_tumbling(spark, sf_dir):
    return jobs.stream_window_means(_sample_stream(spark, sf_dir)).select(
        "window_start", "device", "name", "mean", "n"
    )


@query(
    "util_rows",
    f"""WITH {_MEANS}
    SELECT window_start, device, family, count(*)::INTEGER AS n_names,
           string_agg(name, ',' ORDER BY name) AS names, round(sum(mean), 2) AS total
    FROM means GROUP BY ALL""",
)
def util_rows(spark, sf_dir):
    rows = utilisation_rows(jobs.stream_window_means(_sample_stream(spark, sf_dir)))
    total = F.aggregate(F.map_values("metrics"), F.lit(0.0), lambda acc, x: acc + x)
    return rows.select(
        "window_start", "device", "family",
        F.size("metrics").alias("n_names"),
        F.array_join(F.sort_array(F.map_keys("metrics")), ",").alias("names"),
        F.round(total, 2).alias("total"),
    )


@query(
    "stream_best_so_far",
    """SELECT user_id AS run_id, value AS best, event_id AS best_seq
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events)
    WHERE rn = 1""",
)
def stream_best_so_far(spark, sf_dir):
    reports = stream_table(spark, f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), "value"
    )
    return jobs.stream_best(reports).select("run_id", "best", "best_seq")


@query(
    "stream_score",
    f"""WITH {MODEL}, {_ALL_SCORES}
    SELECT request_id, pos, pred AS prediction FROM v_request_texts LEFT JOIN best USING (doc_id)""",
)
def stream_score(spark, sf_dir):
    inbox = scratch_path(spark, "inbox")
    requests(spark, sf_dir).write.parquet(inbox)
    model, label_map = trained_on_labels(spark, sf_dir)
    return jobs.stream_scores(stream_table(spark, inbox), model, label_map)


@query(
    "stream_metric_log",
    f"WITH {view_sql('v_metrics')} SELECT run_id, name, seq, value FROM v_metrics",
)
def stream_metric_log(spark, sf_dir):
    events = stream_table(spark, f"{sf_dir}/events.parquet")
    metrics = spark.sql(VIEWS["v_metrics"], events=events).select("run_id", "name", "seq", "value")
    return jobs.stream_metric_log(metrics)


@query("util_late", f"WITH {_MEANS} SELECT window_start, device, name, mean, n FROM means")
def util_late(spark, sf_dir):
    """Means from stateless partial sums, with files that each span the whole time, so most samples come late."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "sums")
    table(spark, sf_dir, "events").repartition(3, "event_id").write.parquet(inbox)
    events = stream_table(spark, inbox, files_per_trigger=1)
    partials.run_partials(spark.sql(VIEWS["v_samples"], events=events), out, scratch_path(spark, "sums-state"), 60)
    return partials.merged_means(spark, out).select("window_start", "device", "name", "mean", "n")


@query(
    "stream_bandit",
    """WITH curve AS (SELECT user_id // 10 AS experiment, user_id AS run_id, value,
                             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS interval_no FROM events),
    own AS (SELECT *, max(value) OVER (PARTITION BY run_id ORDER BY interval_no) AS own_best FROM curve),
    peak AS (SELECT experiment, interval_no, max(value) AS value FROM curve GROUP BY ALL),
    best AS (SELECT experiment, interval_no, max(value) OVER (PARTITION BY experiment ORDER BY interval_no) AS best FROM peak),
    behind AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY interval_no) AS rn
               FROM own JOIN best USING (experiment, interval_no)
               WHERE interval_no % 5 = 0 AND own_best < best / 1.1::DOUBLE)
    SELECT experiment, run_id, interval_no::INTEGER AS stopped_at, own_best, best FROM behind WHERE rn = 1""",
)
def stream_bandit(spark, sf_dir):
    """Ten users are the runs of an experiment, their events its reports."""
    events = stream_table(spark, f"{sf_dir}/events.parquet")
    reports = events.select(
        F.floor(F.col("user_id") / 10).alias("experiment"), F.col("user_id").alias("run_id"), "ts",
        F.col("event_id").alias("seq"), "value",
    )
    return jobs.stream_stops(reports)
