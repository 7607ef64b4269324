"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators.encoding import fit_label_map
from reviewloom.operators.splitting import stratified_split
from reviewloom.plans.storage import scratch_path, spread
from reviewloom.queries.base import query
from reviewloom.queries.views import (
    QUALITY_SQL,
    REQUEST_TEXTS_SQL,
    quality,
    request_texts,
    requests,
    split_sql,
    table,
    view,
    view_sql,
)
from reviewloom.sources.datasets import DatasetStore
from reviewloom.sources.label_maps import load_label_map, save_label_map
from reviewloom.sources.metric_log import (
    append_metrics,
    cast_metrics,
    cast_report,
    metric_lists,
    metric_rows,
    read_metrics,
)
from reviewloom.sources.requests import parse_requests, responses
from reviewloom.sources.reviews import read_reviews, write_reviews
from reviewloom.sources.splits import (
    read_split_csv,
    read_split_parquet,
    write_split_csv,
    write_split_parquet,
)


@query(
    "src_reviews_json",
    f"""WITH {view_sql("v_reviews")}
    SELECT review_id, reviewer, asin, review_text, CASE WHEN NOT isnan(overall) THEN overall END AS overall,
           coalesce(isnan(overall), false) AS nan_rating, false AS unreadable
    FROM v_reviews""",
)
def src_reviews_json(spark, sf_dir):
    path = scratch_path(spark, "reviews")
    write_reviews(
        spread(view(spark, sf_dir, "v_reviews"), "review_id").select(
            F.col("reviewer").alias("reviewerID"),
            "asin",
            F.col("review_text").alias("reviewText"),
            "overall",
            F.col("review_id").alias("unixReviewTime"),
        ),
        path,
    )
    nan = F.isnan("overall")
    return read_reviews(spark, path).select(
        F.col("unixReviewTime").alias("review_id"),
        F.col("reviewerID").alias("reviewer"),
        "asin",
        F.col("reviewText").alias("review_text"),
        F.when(~nan, F.col("overall")).alias("overall"),
        F.coalesce(nan, F.lit(False)).alias("nan_rating"),
        F.col("_corrupt_record").isNotNull().alias("unreadable"),
    )


@query(
    "src_reviews_literal",
    f"""WITH {view_sql("v_reviews")}
    SELECT review_id, reviewer, review_text, CASE WHEN NOT isnan(overall) THEN overall END AS overall FROM v_reviews""",
)
def src_reviews_literal(spark, sf_dir):
    """Reviews as dictionary literals, with a bare None for what is missing and a bare True."""
    path = scratch_path(spark, "reviews")
    rows = spread(view(spark, sf_dir, "v_reviews"), "review_id")
    quoted = F.col("review_text")
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(escaped))
    text = F.coalesce(F.concat(F.lit("'"), quoted, F.lit("'")), F.lit("None"))
    stars = F.when(F.isnan("overall"), None).otherwise(F.col("overall"))
    line = F.concat(
        F.lit("{'reviewerID': '"), "reviewer", F.lit("', 'verified': True, 'unixReviewTime': "), F.col("review_id").cast("string"),
        F.lit(", 'overall': "), F.coalesce(stars.cast("string"), F.lit("None")), F.lit(", 'reviewText': "), text, F.lit("}"),
    )
    rows.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return read_reviews(spark, path).select(
        F.col("unixReviewTime").alias("review_id"), F.col("reviewerID").alias("reviewer"), F.col("reviewText").alias("review_text"), "overall"
    )


@query("src_split_csv", f"WITH {view_sql('v_texts')} SELECT doc_id, text, label FROM v_texts")
def src_split_csv(spark, sf_dir):
    texts = view(spark, sf_dir, "v_texts").select("doc_id", "text", "label")
    path = scratch_path(spark, "split-csv")
    write_split_csv(texts, path)
    return read_split_csv(spark, path, texts.schema)


@query(
    "src_split_parquet",
    f"WITH {split_sql(QUALITY_SQL, 'doc_id')} SELECT doc_id, label FROM split WHERE split = 'val'",
)
def src_split_parquet(spark, sf_dir):
    path = scratch_path(spark, "split-parquet")
    write_split_parquet(stratified_split(quality(spark, sf_dir), "label", "doc_id"), path)
    return read_split_parquet(spark, path, "val").select("doc_id", "label")


@query(
    "src_dataset_version",
    f"WITH {split_sql(QUALITY_SQL, 'doc_id', seed=1)} SELECT doc_id, label FROM split WHERE split = 'train'",
)
def src_dataset_version(spark, sf_dir):
    store = DatasetStore(spark, scratch_path(spark, "datasets"))
    for seed in (0, 1):
        split = stratified_split(quality(spark, sf_dir), "label", "doc_id", seed)
        store.register(split.filter("split = 'train'").drop("split"), "train_set", f"seed {seed}")
    return store.read("train_set").select("doc_id", "label")


@query(
    "sink_dataset_register",
    f"""WITH {split_sql(QUALITY_SQL, 'doc_id')}
    SELECT split || '_set' AS name, 1::INTEGER AS version, count(*) AS n_rows FROM split GROUP BY split
    UNION ALL SELECT 'train_set', 2, count(*) FROM split""",
)
def sink_dataset_register(spark, sf_dir):
    store = DatasetStore(spark, scratch_path(spark, "datasets"))
    split = stratified_split(quality(spark, sf_dir), "label", "doc_id")
    for part in ("train", "val", "test"):
        store.register(split.filter(F.col("split") == part).drop("split"), f"{part}_set")
    store.register(split.drop("split"), "train_set", "all labelled rows")
    return store.registry().select("name", "version", "n_rows")


@query(
    "sink_metrics_log",
    f"""WITH {view_sql("v_metrics")}
    SELECT run_id, name, seq, value,
           row_number() OVER (PARTITION BY run_id, name ORDER BY seq) - 1 AS position
    FROM v_metrics""",
)
def sink_metrics_log(spark, sf_dir):
    metrics = view(spark, sf_dir, "v_metrics").select("run_id", "name", "seq", "value")
    path = scratch_path(spark, "metrics")
    append_metrics(metrics.filter("seq % 2 = 0"), path)
    append_metrics(metrics.filter("seq % 2 = 1"), path)
    return metric_lists(read_metrics(spark, path))


@query(
    "metric_text_cast",
    f"""WITH {view_sql("v_metrics")}
    SELECT name, count(*) AS n, count(*) FILTER (seq % 13 <> 0 AND value IS NULL) AS n_missing,
           count(*) FILTER (seq % 13 = 0) AS n_rejected,
           coalesce(sum(round(value * 100)::BIGINT) FILTER (seq % 13 <> 0), 0)::BIGINT AS hundredths
    FROM v_metrics GROUP BY name""",
)
def metric_text_cast(spark, sf_dir):
    """Metrics logged as text: most are numbers, some lists, some are no numbers and get counted."""
    shown = F.col("value").cast("string")
    text = (
        F.when(F.col("seq") % 13 == 0, F.lit("n/a"))
        .when(F.col("seq") % 11 == 0, F.concat(F.lit("["), shown, F.lit(", 0.5]")))
        .otherwise(shown)
    )
    cast = cast_metrics(view(spark, sf_dir, "v_metrics").select("name", text.alias("value")))
    hundredths = cast.groupBy("name").agg(F.coalesce(F.sum(F.round(F.col("value") * 100).cast("bigint")), F.lit(0)).alias("hundredths"))
    return cast_report(cast, ["name"]).join(hundredths, "name")


_EVENTS = ("click", "view", "purchase", "signup", "error")
_LAST = ", ".join(
    f"max_by(value, seq) FILTER (name = 'test_{e}') AS test_{e}" for e in _EVENTS
)


@query(
    "sink_metric_rows",
    f"""WITH {view_sql("v_metrics")}
    SELECT run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_LAST}
    FROM v_metrics GROUP BY run_id, CAST(ts AS DATE)""",
)
def sink_metric_rows(spark, sf_dir):
    metrics = view(spark, sf_dir, "v_metrics").withColumn("day", F.col("ts").cast("date").cast("string"))
    return metric_rows(metrics, ["run_id", "day"], [f"test_{e}" for e in _EVENTS])


@query(
    "src_score_request",
    f"""WITH {REQUEST_TEXTS_SQL}
    SELECT request_id, pos, text, 1.0::DOUBLE AS global_parameter, CAST(NULL AS VARCHAR) AS error FROM v_request_texts""",
)
def src_score_request(spark, sf_dir):
    return parse_requests(requests(spark, sf_dir))


@query(
    "sink_score_response",
    f"""WITH {REQUEST_TEXTS_SQL}
    SELECT request_id, '[' || string_agg(coalesce(length(text)::VARCHAR, 'null'), ',' ORDER BY pos) || ']' AS response,
           count(*)::INTEGER AS n_items
    FROM v_request_texts GROUP BY request_id""",
)
def sink_score_response(spark, sf_dir):
    scored = request_texts(spark, sf_dir).select(
        "request_id", F.col("doc_id").alias("pos"), F.length("text").alias("prediction")
    )
    return responses(scored)


@query(
    "label_map_roundtrip",
    """SELECT lang || '/' || source AS label, dense_rank() OVER (ORDER BY lang || '/' || source) - 1 AS idx
    FROM (SELECT DISTINCT lang, source FROM documents)""",
)
def label_map_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "label-map")
    named = table(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", "source").alias("label"))
    save_label_map(fit_label_map(named, "label"), path)
    return load_label_map(spark, path)
