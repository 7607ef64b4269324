"""Run trees, metric logs, the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions import metric_names as names
from reviewloom.functions.versions import deployment_name, pipeline_name
from reviewloom.operators import model_registry as mr
from reviewloom.operators import runs as ra
from reviewloom.plans.storage import scratch_path
from reviewloom.queries.base import query
from reviewloom.queries.views import table, view, view_sql

METRIC = "test_auc_weighted"
_FIRST = f"""{view_sql("v_runs", "v_run_metrics")},
firsts AS (SELECT run_id, arg_min_null(value, seq) AS value FROM v_run_metrics WHERE name = '{METRIC}' GROUP BY run_id),
scored AS (SELECT r.*, f.value FROM v_runs r JOIN firsts f ON r.run_id = f.run_id
           WHERE f.value IS NOT NULL AND NOT isnan(f.value))"""


def _runs(spark, sf_dir):
    return view(spark, sf_dir, "v_runs"), view(spark, sf_dir, "v_run_metrics")


@query(
    "metric_prefix",
    f"""WITH {view_sql("v_metrics")}
    SELECT run_id, seq, 'train_' || replace(name, 'test_', '') AS name, value FROM v_metrics""",
)
def metric_prefix(spark, sf_dir):
    return view(spark, sf_dir, "v_metrics").select(
        "run_id", "seq", names.prefixed(F.col("name"), "train").alias("name"), "value"
    )


@query(
    "util_key_filter",
    f"""WITH {view_sql("v_samples")} SELECT event_id, key FROM v_samples
    WHERE key LIKE '%mean%' AND key NOT LIKE '%load_average%' AND key NOT LIKE '%fan_speed%' AND key NOT LIKE '%pid%'""",
)
def util_key_filter(spark, sf_dir):
    return (
        view(spark, sf_dir, "v_samples").filter(names.is_kept_sample(F.col("key"))).select("event_id", "key")
    )


_NORMAL = "split_part(key, ' ', 1) || CASE WHEN contains(key, '%') THEN ' %' ELSE '' END"


@query(
    "util_key_normalise",
    f"""WITH {view_sql("v_samples")}
    SELECT event_id, {_NORMAL} AS name, coalesce(round_even(value / 7, 2), 0) AS value FROM v_samples""",
)
def util_key_normalise(spark, sf_dir):
    return view(spark, sf_dir, "v_samples").select(
        "event_id",
        names.normal_key(F.col("key")).alias("name"),
        names.normal_value(F.col("value") / 7).alias("value"),
    )


@query(
    "util_gpu_extract",
    f"""WITH {view_sql("v_samples")}
    SELECT event_id, CASE WHEN contains(key, 'gpu') AND regexp_extract({_NORMAL}, '/gpu:\\d+/') <> ''
                          THEN regexp_extract({_NORMAL}, '/gpu:\\d+/') ELSE 'host' END AS device FROM v_samples""",
)
def util_gpu_extract(spark, sf_dir):
    return view(spark, sf_dir, "v_samples").select(
        "event_id", names.device_of(names.normal_key(F.col("key"))).alias("device")
    )


@query(
    "runs_with_metric",
    f"""WITH {view_sql("v_runs", "v_run_metrics")}
    SELECT run_id, name FROM v_runs
    WHERE run_id IN (SELECT run_id FROM v_run_metrics WHERE name = '{METRIC}')""",
)
def runs_with_metric(spark, sf_dir):
    return ra.runs_with_metric(*_runs(spark, sf_dir), METRIC).select("run_id", "name")


@query(
    "run_by_id_substr",
    f"""WITH {view_sql("v_runs")}
    SELECT run_id, name FROM v_runs WHERE contains(run_id, '14') ORDER BY seq LIMIT 1""",
)
def run_by_id_substr(spark, sf_dir):
    return ra.run_by_id_part(view(spark, sf_dir, "v_runs"), "14").select("run_id", "name")


@query(
    "run_by_name",
    f"""WITH {view_sql("v_runs")}
    SELECT run_id, name FROM v_runs WHERE name = 'AutoML_Classification' ORDER BY seq LIMIT 1""",
)
def run_by_name(spark, sf_dir):
    return ra.run_by_name(view(spark, sf_dir, "v_runs"), ra.FAMILY_STEP).select("run_id", "name")


@query(
    "run_family_flag",
    f"""WITH {view_sql("v_runs")} SELECT run_id, contains(name, 'AutoML') AS is_automl FROM v_runs""",
)
def run_family_flag(spark, sf_dir):
    return ra.with_family(view(spark, sf_dir, "v_runs")).select("run_id", "is_automl")


@query(
    "run_tree",
    f"""WITH RECURSIVE {view_sql("v_runs")},
    tree AS (SELECT run_id, run_id AS root_id, 0 AS depth FROM v_runs WHERE parent_id IS NULL
             UNION ALL
             SELECT r.run_id, t.root_id, t.depth + 1 FROM v_runs r JOIN tree t ON r.parent_id = t.run_id)
    SELECT run_id, root_id, depth FROM tree""",
)
def run_tree(spark, sf_dir):
    return ra.flatten_runs(view(spark, sf_dir, "v_runs"))


@query(
    "run_metric_join",
    f"""WITH {view_sql("v_metrics")},
    s AS (SELECT run_id, name AS metric, count(*) AS n_values, min_by(value, seq) AS first_value,
                 max_by(value, seq) AS last_value FROM v_metrics GROUP BY ALL)
    SELECT s.*, c.c_name AS run_name FROM s JOIN customer c ON c.c_custkey = s.run_id""",
)
def run_metric_join(spark, sf_dir):
    """Event users are the runs; they carry their customer's name."""
    runs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("run_id"), F.col("c_name").alias("name")
    )
    return ra.run_metrics(runs, view(spark, sf_dir, "v_metrics"))


_LINEAGE = ", ".join(
    f"arg_max(version, (seq, version)) FILTER (name = '{name}') AS {column}"
    for name, column in ra.ROLES.items()
)


@query(
    "run_lineage",
    f"WITH {view_sql('v_run_inputs')} SELECT run_id, {_LINEAGE} FROM v_run_inputs GROUP BY run_id",
)
def run_lineage(spark, sf_dir):
    return ra.lineage(view(spark, sf_dir, "v_run_inputs"))


@query("best_run", f"WITH {_FIRST} SELECT run_id, name, value FROM scored ORDER BY value DESC, seq LIMIT 1")
def best_run(spark, sf_dir):
    return ra.best_run(*_runs(spark, sf_dir), METRIC).select("run_id", "name", "value")


@query("best_metric_value", f"WITH {_FIRST} SELECT max(value) AS best_value FROM firsts WHERE NOT isnan(value)")
def best_metric_value(spark, sf_dir):
    return ra.best_value(view(spark, sf_dir, "v_run_metrics"), METRIC)


@query(
    "run_counts",
    f"""WITH {view_sql("v_runs", "v_run_metrics")}
    SELECT count(*) AS n_examined,
           count(*) FILTER (run_id IN (SELECT run_id FROM v_run_metrics WHERE name = '{METRIC}')) AS n_valid
    FROM v_runs""",
)
def run_counts(spark, sf_dir):
    return ra.run_counts(*_runs(spark, sf_dir), METRIC)


@query(
    "best_child",
    f"""WITH {_FIRST}
    SELECT parent_id, run_id, value
    FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY value DESC, seq) AS rn FROM scored
          WHERE parent_id IS NOT NULL) WHERE rn = 1""",
)
def best_child(spark, sf_dir):
    return ra.best_child(*_runs(spark, sf_dir), METRIC)


@query(
    "best_checkpoint",
    """SELECT user_id AS run_id, event_id AS epoch, value AS loss
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events)
    WHERE rn = 1""",
)
def best_checkpoint(spark, sf_dir):
    losses = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("epoch"), F.col("value").alias("loss")
    )
    return ra.best_checkpoint(losses)


@query(
    "leaderboard",
    """SELECT o_orderpriority AS experiment, o_orderkey AS run_id, metric,
              rank() OVER (PARTITION BY o_orderpriority ORDER BY metric DESC) AS rank
    FROM (SELECT *, round(o_totalprice / 100, 0) AS metric FROM orders)""",
)
def leaderboard(spark, sf_dir):
    scores = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderkey").alias("run_id"),
        F.round(F.col("o_totalprice") / 100, 0).alias("metric"),
    )
    return ra.leaderboard(scores, "experiment", "metric", "run_id")


@query(
    "bandit_terminate",
    """WITH curve AS (SELECT user_id AS run_id, value,
                             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS interval_no FROM events),
    own AS (SELECT *, max(value) OVER (PARTITION BY run_id ORDER BY interval_no) AS own_best FROM curve),
    peak AS (SELECT interval_no, max(value) AS value FROM curve GROUP BY 1),
    best AS (SELECT interval_no, max(value) OVER (ORDER BY interval_no) AS best FROM peak)
    SELECT run_id, min(interval_no) AS stopped_at FROM own JOIN best USING (interval_no)
    WHERE interval_no % 5 = 0 AND own_best < best / 1.1::DOUBLE GROUP BY run_id""",
)
def bandit_terminate(spark, sf_dir):
    reports = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", "value"
    )
    curve = ra.numbered_intervals(reports, [F.col("ts"), F.col("event_id")])
    return ra.bandit_stops(curve)


@query(
    "registry_latest",
    f"""WITH {view_sql("v_registry")}
    SELECT model_name, version, run_id, metric FROM v_registry r
    WHERE version = (SELECT max(version) FROM v_registry s WHERE s.model_name = r.model_name)""",
)
def registry_latest(spark, sf_dir):
    return mr.latest_versions(view(spark, sf_dir, "v_registry")).select(
        "model_name", "version", "run_id", "metric"
    )


@query(
    "retire_old_versions",
    f"""WITH {view_sql("v_registry")}
    SELECT model_name, version, run_id FROM
      (SELECT *, max(version) OVER (PARTITION BY model_name) AS newest FROM v_registry) WHERE version <> newest""",
)
def retire_old_versions(spark, sf_dir):
    return mr.old_versions(view(spark, sf_dir, "v_registry")).select("model_name", "version", "run_id")


@query(
    "version_name",
    f"""WITH {view_sql("v_registry")}
    SELECT run_id, 'Review-Labels-' || strftime(created, '%Y-%m-%d-%H-%M') || '-Pipeline' AS pipeline,
           'deployment-' || strftime(created, '%m%d%H%M%f') AS deployment FROM v_registry""",
)
def version_name(spark, sf_dir):
    created = F.col("created")
    return view(spark, sf_dir, "v_registry").select(
        "run_id",
        pipeline_name("Review-Labels", created).alias("pipeline"),
        deployment_name(created).alias("deployment"),
    )


_SMOKE = f"""{view_sql("v_registry")},
newest AS (SELECT model_name, max(version) AS newest FROM v_registry GROUP BY model_name),
smoke AS (SELECT l_orderkey + 1 AS version, count(*) AS n_valid, count(*) FILTER (l_linestatus = 'O' OR l_tax < 0.07) AS n_replies
          FROM lineitem GROUP BY 1),
gate AS (SELECT model_name, newest, coalesce(n_valid = n_replies, false) AS passed
         FROM newest LEFT JOIN smoke ON smoke.version = newest.newest)"""


@query(
    "promotion_gate",
    f"""WITH {_SMOKE}
    SELECT r.model_name, r.version, passed,
           CASE WHEN r.version = newest AND passed THEN 'promote' WHEN r.version = newest THEN 'abort'
                WHEN passed THEN 'retire' ELSE 'keep' END AS action,
           CASE WHEN r.version = newest AND passed THEN 100::INTEGER END AS traffic
    FROM v_registry r JOIN gate g ON r.model_name = g.model_name""",
)
def promotion_gate(spark, sf_dir):
    """The line items of an order are the sample requests sent to its model version."""
    registry = view(spark, sf_dir, "v_registry")
    replied = (F.col("l_linestatus") == "O") | (F.col("l_tax") < 0.07)
    tried = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_orderkey") + 1).alias("version"))
        .agg(F.count(F.lit(1)).alias("n_valid"), F.count(F.when(replied, 1)).alias("n_replies"))
    )
    smoke = registry.select("model_name", "version").join(tried, "version")
    return mr.promotion_plan(registry, smoke)


@query(
    "register_best",
    f"""WITH {_FIRST}, {view_sql("v_run_inputs", "v_registry")},
    win AS (SELECT *, contains(name, 'AutoML') AS is_automl FROM scored ORDER BY value DESC, seq LIMIT 1),
    step AS (SELECT run_id FROM v_runs WHERE name = 'AutoML_Classification' ORDER BY seq LIMIT 1),
    src AS (SELECT value, is_automl, CASE WHEN is_automl THEN (SELECT run_id FROM step) ELSE run_id END AS run_id FROM win),
    lin AS (SELECT run_id, {_LINEAGE} FROM v_run_inputs GROUP BY run_id)
    SELECT '1-URGENT' AS model_name,
           (SELECT max(version) + 1 FROM v_registry WHERE model_name = '1-URGENT') AS version,
           src.run_id, is_automl, src.run_id AS tag_run_id, '{METRIC}' AS tag_metric,
           train_version, val_version, value AS metric
    FROM src LEFT JOIN lin ON lin.run_id = src.run_id""",
)
def register_best(spark, sf_dir):
    runs, metrics = _runs(spark, sf_dir)
    entry = mr.winner_entry(
        runs, metrics, view(spark, sf_dir, "v_run_inputs"), view(spark, sf_dir, "v_registry"),
        METRIC, "1-URGENT",
    )
    path = scratch_path(spark, "registry")
    mr.append_registry(entry, path)
    return mr.read_registry(spark, path, entry.schema).select(
        "model_name", "version", "run_id", "is_automl",
        F.col("tags")["run_id"].alias("tag_run_id"), F.col("tags")["metric_name"].alias("tag_metric"),
        "train_version", "val_version", "metric",
    )
