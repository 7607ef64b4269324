"""The given tables in the shapes the operators work on.

Every view is as large as the table it comes from. The SQL texts run in Spark and in the checking
engine; table names are placeholders.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.plans.storage import spread

VIEWS = {
    # Star ratings 1..5 with missing texts, missing ratings and NaN ratings mixed in.
    "v_reviews": """
        SELECT doc_id AS review_id, source AS reviewer, lang AS asin,
               CASE WHEN doc_id % 97 = 0 THEN NULL ELSE text END AS review_text,
               CASE WHEN doc_id % 89 = 0 THEN CAST('NaN' AS DOUBLE)
                    WHEN doc_id % 83 = 0 THEN NULL
                    ELSE CAST(1 + doc_id % 5 AS DOUBLE) END AS overall
        FROM {documents}""",
    # Labelled texts; some texts are empty or missing.
    "v_texts": """
        SELECT d.doc_id,
               CASE WHEN d.doc_id % 97 = 0 THEN NULL WHEN d.doc_id % 53 = 0 THEN '' ELSE d.text END AS text,
               l.quality AS label
        FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id""",
    # Binary truth, prediction and tied scores.
    "v_pred": """
        SELECT doc_id, quality AS label,
               CASE WHEN (doc_id * 7) % 10 < 7 THEN quality ELSE 1 - quality END AS pred,
               CAST((doc_id * 7919) % 101 AS DOUBLE) / 100 AS score
        FROM {labels}""",
    # Three-level run tree: a pipeline per customer, its steps, and the trials of each step.
    "v_runs": """
        SELECT concat('c', c_custkey) AS run_id, CAST(NULL AS STRING) AS parent_id,
               'Pipeline' AS name, -1 - c_custkey AS seq
        FROM {customer}
        UNION ALL
        SELECT concat('o', o_orderkey), concat('c', o_custkey),
               CASE WHEN o_orderkey % 3 = 0 THEN 'AutoML_Classification'
                    WHEN o_orderkey % 3 = 1 THEN 'Test_AutoML_Best_Model' ELSE 'Sweep_Step' END,
               o_orderkey * 10
        FROM {orders}
        UNION ALL
        SELECT DISTINCT concat('t', l_orderkey, '_', l_linenumber), concat('o', l_orderkey),
               CASE WHEN l_orderkey % 3 = 0 THEN 'AutoML_Trial' ELSE 'Sweep_Trial' END,
               l_orderkey * 10 + l_linenumber
        FROM {lineitem}""",
    # Metric values of the trials; some trials log several, some none, some are not numbers.
    "v_run_metrics": """
        SELECT concat('t', l_orderkey, '_', l_linenumber) AS run_id,
               CASE WHEN l_orderkey % 4 = 3 THEN 'val_auc_weighted' ELSE 'test_auc_weighted' END AS name,
               l_partkey * 100000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS seq,
               CASE WHEN l_partkey % 97 = 0 THEN CAST('NaN' AS DOUBLE)
                    WHEN l_partkey % 89 = 0 THEN NULL ELSE l_discount END AS value
        FROM {lineitem}""",
    # Flat metric log.
    "v_metrics": """
        SELECT user_id AS run_id, concat('test_', event_type) AS name, event_id AS seq, ts, value
        FROM {events}""",
    # Dataset versions used by trials and steps; the latest per name counts.
    "v_run_inputs": """
        SELECT concat('t', l_orderkey, '_', l_linenumber) AS run_id, 'train_set' AS name,
               l_shipdate AS seq, l_partkey AS version
        FROM {lineitem}
        UNION ALL
        SELECT concat('t', l_orderkey, '_', l_linenumber), 'val_set', l_shipdate, l_suppkey
        FROM {lineitem}
        UNION ALL
        SELECT concat('o', l_orderkey),
               CASE l_linenumber WHEN 1 THEN 'train_set' WHEN 2 THEN 'val_set'
                                 WHEN 3 THEN 'test_set' ELSE 'other' END,
               l_shipdate, l_partkey
        FROM {lineitem}""",
    # Model versions: a few names with very many versions each.
    "v_registry": """
        SELECT o_orderpriority AS model_name, o_orderkey + 1 AS version, o_orderkey AS run_id,
               o_orderdate AS created, o_totalprice AS metric
        FROM {orders}""",
    # Utilisation samples.
    "v_samples": """
        SELECT event_id, ts, value,
               CASE event_type
                 WHEN 'click' THEN concat('metrics/gpu:', user_id % 4, '/gpu_utilization (%)/mean')
                 WHEN 'view' THEN concat('metrics/gpu:', user_id % 4, '/memory_used (MiB)/mean')
                 WHEN 'purchase' THEN 'metrics/host/cpu_percent (%)/mean'
                 WHEN 'signup' THEN concat('metrics/gpu:', user_id % 4, '/fan_speed (%)/mean')
                 ELSE 'metrics/host/memory_percent (%)/mean' END AS key
        FROM {events}""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The document texts, ready for row by row work on all cores."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns), "doc_id")


def _names(sql: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(sql) if field})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in _names(sql)})


def view_sql(*names: str) -> str:
    """The views as a WITH clause body."""
    return ",\n".join(
        f"{n} AS ({VIEWS[n].format(**{t: t for t in _names(VIEWS[n])})})" for n in names
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten class scores per vector, with its true class."""
    scores = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", scores.alias("logits"), "label")


LOGITS_SQL = """v_logits AS (
    SELECT vec_id, list_transform(embedding[1:10], lambda x: x::DOUBLE) AS logits, label
    FROM embeddings)"""

# Texts per scoring request.
REQUEST_SIZE = 8


def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the texts of scoring requests; some texts are missing."""
    return documents(spark, sf_dir).select(
        F.floor(F.col("doc_id") / REQUEST_SIZE).cast("bigint").alias("request_id"),
        "doc_id",
        F.when(F.col("doc_id") % 97 != 0, F.col("text")).alias("text"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON requests of at most REQUEST_SIZE texts: even ids in the plain shape, odd in the nested."""
    items = F.sort_array(F.collect_list(F.struct("doc_id", "text")))
    keep = {"ignoreNullFields": "false"}
    plain = F.to_json(
        F.struct(F.transform("items", lambda i: F.struct(i["text"].alias("text"))).alias("data")), keep
    )
    nested = F.to_json(
        F.struct(
            F.struct(
                F.transform("items", lambda i: F.struct(i["text"].alias("reviewText"))).alias("data")
            ).alias("Inputs")
        ),
        keep,
    )
    return (
        request_texts(spark, sf_dir)
        .groupBy("request_id")
        .agg(items.alias("items"))
        .select("request_id", F.when(F.col("request_id") % 2 == 0, plain).otherwise(nested).alias("raw"))
    )


REQUEST_TEXTS_SQL = f"""v_request_texts AS (
    SELECT doc_id // {REQUEST_SIZE} AS request_id, doc_id,
           (row_number() OVER (PARTITION BY doc_id // {REQUEST_SIZE} ORDER BY doc_id) - 1)::INTEGER AS pos,
           CASE WHEN doc_id % 97 <> 0 THEN text END AS text
    FROM documents)"""


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label) without the texts."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def with_text(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attaches the document texts, after the narrow work on the keys is done."""
    return documents(spark, sf_dir).join(rows, "doc_id")


QUALITY_SQL = "SELECT doc_id, quality AS label FROM labels"
TOKEN_SQL = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')"


def tokens_sql(column: str) -> str:
    return TOKEN_SQL.format(column)


def split_sql(source: str, key: str, seed: int = 0, name: str = "split") -> str:
    """CTEs that split ``source`` (key, label): the split is the table called ``name``."""
    p = name
    return f"""{p}_lab AS ({source}),
{p}_cls AS (SELECT label, count(*) AS n FROM {p}_lab GROUP BY label),
{p}_tot AS (SELECT sum(n)::BIGINT AS total, (sum(n)::BIGINT + 4) // 5 AS hold FROM {p}_cls),
{p}_q1 AS (SELECT label, n, hold, total, n * (total - hold) // total AS fl, n * (total - hold) % total AS rem
          FROM {p}_cls, {p}_tot),
{p}_q2 AS (SELECT *, total - hold - sum(fl) OVER () AS spare,
                 row_number() OVER (ORDER BY rem DESC, label) AS place FROM {p}_q1),
{p}_q3 AS (SELECT label, hold, n, fl + CASE WHEN place <= spare THEN 1 ELSE 0 END AS n_train FROM {p}_q2),
{p}_q4 AS (SELECT label, hold, n_train, (n - n_train) * (hold - (hold + 1) // 2) // hold AS fl,
                 (n - n_train) * (hold - (hold + 1) // 2) % hold AS rem FROM {p}_q3),
{p}_q5 AS (SELECT *, hold - (hold + 1) // 2 - sum(fl) OVER () AS spare,
                 row_number() OVER (ORDER BY rem DESC, label) AS place FROM {p}_q4),
{p}_quota AS (SELECT label, n_train, n_train + fl + CASE WHEN place <= spare THEN 1 ELSE 0 END AS upto
             FROM {p}_q5),
{p}_ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{seed}:' || {key}), {key}) AS rn
              FROM {p}_lab),
{p} AS (SELECT r.* EXCLUDE (rn), CASE WHEN rn <= n_train THEN 'train' WHEN rn <= upto THEN 'val'
                                      ELSE 'test' END AS split
       FROM {p}_ranked r JOIN {p}_quota q ON r.label = q.label)"""
