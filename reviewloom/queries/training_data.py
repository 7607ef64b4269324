"""Preparation, splits, samples and label maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.labels import argmax
from reviewloom.operators import encoding, preparation, splitting, sweep
from reviewloom.queries.base import query
from reviewloom.queries.views import (
    LOGITS_SQL,
    QUALITY_SQL,
    logits,
    quality,
    split_sql,
    table,
    view,
    view_sql,
)

_SENTIMENT = """CASE WHEN overall IS NULL OR isnan(overall) THEN NULL
                     WHEN overall >= 4 THEN 1.0::DOUBLE WHEN overall < 3 THEN 0.0::DOUBLE END"""
_LANG_SQL = "SELECT doc_id, lang AS label FROM documents"


def _reviews(spark, sf_dir):
    return preparation.label_by_threshold(view(spark, sf_dir, "v_reviews"), "overall")


@query(
    "label_threshold",
    f"WITH {view_sql('v_reviews')} SELECT review_id, {_SENTIMENT} AS sentiment FROM v_reviews",
)
def label_threshold(spark, sf_dir):
    return _reviews(spark, sf_dir).select("review_id", "sentiment")


@query(
    "project_dropna",
    f"""WITH {view_sql('v_reviews')}
    SELECT review_id, review_text, sentiment
    FROM (SELECT review_id, review_text, {_SENTIMENT} AS sentiment FROM v_reviews)
    WHERE review_text IS NOT NULL AND sentiment IS NOT NULL""",
)
def project_dropna(spark, sf_dir):
    return preparation.complete_rows(
        _reviews(spark, sf_dir), ["review_id", "review_text", "sentiment"]
    )


@query(
    "split_xy_rejoin",
    f"WITH {view_sql('v_reviews')} SELECT review_id, review_text, {_SENTIMENT} AS sentiment FROM v_reviews",
)
def split_xy_rejoin(spark, sf_dir):
    reviews = _reviews(spark, sf_dir).select("review_id", "review_text", "sentiment")
    features, target = preparation.detach(reviews, "review_id", "sentiment")
    return preparation.attach(features, target, "review_id")


@query(
    "preview_head",
    f"""WITH {view_sql('v_reviews')}
    SELECT review_id, reviewer, {_SENTIMENT} AS sentiment FROM v_reviews ORDER BY review_id LIMIT 5""",
)
def preview_head(spark, sf_dir):
    return preparation.preview(
        _reviews(spark, sf_dir).select("review_id", "reviewer", "sentiment"), "review_id"
    )


@query(
    "split_counts",
    f"""WITH {split_sql(_LANG_SQL, 'doc_id')}
    SELECT split, label, count(*) AS n_rows FROM split GROUP BY ALL""",
)
def split_counts(spark, sf_dir):
    return preparation.row_counts(_lang_split(spark, sf_dir), "split", "label")


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "describe_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
        round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max
        FROM lineitem"""
        for c in _DESCRIBED
    ),
)
def describe_stats(spark, sf_dir):
    described = preparation.describe(table(spark, sf_dir, "lineitem"), _DESCRIBED)
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return described.select("column_name", "n", "min", "max", *rounded)


@query(
    "num_labels",
    f"""WITH {view_sql('v_reviews')}
    SELECT count(DISTINCT CASE WHEN NOT isnan(overall) THEN overall END)
           + max(CASE WHEN overall IS NULL OR isnan(overall) THEN 1 ELSE 0 END) AS n_labels
    FROM v_reviews""",
)
def num_labels(spark, sf_dir):
    return preparation.distinct_with_missing(view(spark, sf_dir, "v_reviews"), "overall")


def _lang_split(spark, sf_dir, seed=0):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return splitting.stratified_split(rows, "label", "doc_id", seed)


@query(
    "stratified_split",
    f"WITH {split_sql(_LANG_SQL, 'doc_id')} SELECT doc_id, label, split FROM split",
)
def stratified_split(spark, sf_dir):
    return _lang_split(spark, sf_dir).select("doc_id", "label", "split")


@query(
    "stratified_sample_n",
    """WITH cls AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1),
    tot AS (SELECT sum(n)::BIGINT AS total FROM cls),
    q1 AS (SELECT label, n * 4000 // total AS fl, n * 4000 % total AS rem, total FROM cls, tot),
    q2 AS (SELECT *, 4000 - sum(fl) OVER () AS spare, row_number() OVER (ORDER BY rem DESC, label) AS place FROM q1),
    quota AS (SELECT label, total, fl + CASE WHEN place <= spare THEN 1 ELSE 0 END AS upto FROM q2),
    ranked AS (SELECT o_orderkey, o_orderpriority AS label,
                      row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('0:' || o_orderkey), o_orderkey) AS rn
               FROM orders)
    SELECT o_orderkey, r.label FROM ranked r JOIN quota q ON r.label = q.label WHERE total <= 4000 OR rn <= upto""",
)
def stratified_sample_n(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return splitting.stratified_sample(rows, "label", "o_orderkey", 4000).select("o_orderkey", "label")


@query(
    "shuffle_rows",
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1 AS row_index FROM orders",
)
def shuffle_rows(spark, sf_dir):
    return splitting.shuffled(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


@query(
    "final_union",
    f"""WITH {split_sql(QUALITY_SQL, 'doc_id')}
    SELECT doc_id, label, CASE WHEN split = 'test' THEN doc_id % 10 END AS fold FROM split""",
)
def final_union(spark, sf_dir):
    split = splitting.stratified_split(quality(spark, sf_dir), "label", "doc_id")
    train, val, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
    return splitting.final_training_set(
        train, val.select("label", "doc_id"), test.withColumn("fold", F.col("doc_id") % 10)
    )


@query(
    "split_overlap_check",
    f"""WITH {split_sql(QUALITY_SQL, 'doc_id')}
    SELECT count(*) FILTER (split = 'val') AS train_val, count(*) FILTER (split = 'test') AS train_test,
           0::BIGINT AS val_test
    FROM split""",
)
def split_overlap_check(spark, sf_dir):
    """Final mode trains on every row, so val and test rows are found in train."""
    split = splitting.stratified_split(quality(spark, sf_dir), "label", "doc_id")
    final = split.select("doc_id", F.lit("train").alias("split"))
    held_out = split.filter("split <> 'train'").select("doc_id", "split")
    return splitting.split_overlaps(final.unionByName(held_out), "doc_id")


@query(
    "target_list",
    """SELECT source AS label, min(doc_id) AS first_seen,
              row_number() OVER (ORDER BY min(doc_id)) - 1 AS position
    FROM documents GROUP BY source""",
)
def target_list(spark, sf_dir):
    return encoding.target_list(table(spark, sf_dir, "documents"), "source", "doc_id")


@query(
    "label_encoder_fit",
    """SELECT l_extendedprice AS label, row_number() OVER (ORDER BY l_extendedprice) - 1 AS idx
    FROM (SELECT DISTINCT l_extendedprice FROM lineitem)""",
)
def label_encoder_fit(spark, sf_dir):
    return encoding.fit_label_map(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(
    "encode_labels",
    """SELECT doc_id, lang, m.idx AS labels FROM documents JOIN
    (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS idx FROM (SELECT DISTINCT lang FROM documents)) m
    USING (lang)""",
)
def encode_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return encoding.encode_labels(documents, encoding.fit_label_map(documents, "lang"), "lang")


@query(
    "unseen_labels",
    """SELECT DISTINCT n_chars AS label FROM documents
    WHERE n_chars NOT IN (SELECT n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""",
)
def unseen_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = documents.join(quality(spark, sf_dir), "doc_id", "left_semi")
    return encoding.unseen_labels(documents, encoding.fit_label_map(labelled, "n_chars"), "n_chars")


@query(
    "decode_labels",
    f"""WITH {LOGITS_SQL}, names AS (SELECT source AS label, row_number() OVER (ORDER BY source) - 1 AS idx
        FROM (SELECT DISTINCT source FROM documents))
    SELECT vec_id, label AS prediction
    FROM (SELECT vec_id, list_position(logits, list_max(logits)) - 1 AS pred FROM v_logits) v
    LEFT JOIN names ON names.idx = v.pred""",
)
def decode_labels(spark, sf_dir):
    names = encoding.fit_label_map(table(spark, sf_dir, "documents"), "source")
    predicted = logits(spark, sf_dir).select("vec_id", argmax(F.col("logits")).alias("pred"))
    return encoding.decode_labels(predicted, names, "pred").select("vec_id", "prediction")


_SPACE = {
    "learning_rate": sweep.LEARNING_RATES,
    "batch_size": (8, 16, 32),
    "dropout": sweep.LogUniform(-4.0, -1.0),
}


def _draw_sql(name):
    return f"('0x' || substr(md5('0:' || c_custkey || ':' || trial_id || ':{name}'), 1, 8))::BIGINT"


@query(
    "sweep_sample",
    f"""SELECT c_custkey, trial_id::INTEGER AS trial_id,
      ([{', '.join(f'{v!r}::DOUBLE' for v in sweep.LEARNING_RATES)}])[{_draw_sql('learning_rate')} % 8 + 1] AS learning_rate,
      ([8, 16, 32])[{_draw_sql('batch_size')} % 3 + 1] AS batch_size,
      round(exp(-4.0::DOUBLE + {_draw_sql('dropout')} / 4294967296.0::DOUBLE * 3.0::DOUBLE), 6) AS dropout
    FROM customer, range(20) t(trial_id)""",
)
def sweep_sample(spark, sf_dir):
    """Twenty trials for every experiment; each customer stands for one."""
    trials = sweep.sample_trials(table(spark, sf_dir, "customer"), "c_custkey", _SPACE)
    return trials.withColumn("dropout", F.round("dropout", 6))


@query(
    "sweep_grid",
    f"""SELECT c_custkey, learning_rate, batch_size FROM customer,
      (SELECT DISTINCT unnest([{', '.join(f'{v!r}::DOUBLE' for v in sweep.LEARNING_RATES)}]) AS learning_rate),
      (SELECT unnest([8, 16, 32]) AS batch_size)""",
)
def sweep_grid(spark, sf_dir):
    space = {k: _SPACE[k] for k in ("learning_rate", "batch_size")}
    return sweep.grid_trials(table(spark, sf_dir, "customer"), "c_custkey", space)


@query(
    "trial_waves",
    """SELECT l_orderkey, l_linenumber, l_partkey, ((l_linenumber - 1) // 3)::INTEGER AS wave
    FROM lineitem WHERE l_linenumber - 1 < 5""",
)
def trial_waves(spark, sf_dir):
    """Line items stand for the numbered trials of an order; five may run, three at a time."""
    trials = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_linenumber") - 1).alias("trial_id")
    )
    return sweep.schedule(trials, "trial_id", cap=5).drop("trial_id")
