"""Classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.functions.labels import argmax
from reviewloom.operators import classification as cl
from reviewloom.queries.base import query
from reviewloom.queries.views import LOGITS_SQL, logits, table, view, view_sql

_BINARY = f"{view_sql('v_pred')}, p AS (SELECT label, pred FROM v_pred)"
_MULTI = f"""{LOGITS_SQL}, p AS (
    SELECT label, (list_position(logits, list_max(logits)) - 1)::INTEGER AS pred FROM v_logits)"""
PER_CLASS_SQL = """cls AS (
    SELECT c AS cls, count(*) FILTER (label = c) AS support, count(*) FILTER (pred = c) AS predicted,
           count(*) FILTER (label = c AND pred = c) AS hits
    FROM p, (SELECT label AS c FROM p UNION SELECT pred FROM p) GROUP BY c),
sc AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE hits / predicted END AS pr,
              CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits / support END AS re,
              CASE WHEN support + predicted = 0 THEN 0.0::DOUBLE ELSE 2 * hits / (support + predicted) END AS f
       FROM cls)"""


def _predicted(spark, sf_dir):
    return logits(spark, sf_dir).withColumn("pred", argmax(F.col("logits")))


def _rounded(df, *keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in df.columns if c not in keep])


@query(
    "argmax_pred",
    f"""WITH {LOGITS_SQL}
    SELECT vec_id, (list_position(logits, list_max(logits)) - 1)::INTEGER AS pred FROM v_logits""",
)
def argmax_pred(spark, sf_dir):
    return _predicted(spark, sf_dir).select("vec_id", "pred")


@query("confusion_matrix", f"WITH {_MULTI} SELECT label, pred, count(*) AS n FROM p GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return cl.confusion(_predicted(spark, sf_dir), "label", "pred")


@query(
    "metric_accuracy",
    f"WITH {_MULTI} SELECT round(avg((label = pred)::INTEGER), 6) AS accuracy FROM p",
)
def metric_accuracy(spark, sf_dir):
    return _rounded(cl.accuracy(_predicted(spark, sf_dir), "label", "pred"))


@query(
    "metrics_macro",
    f"""WITH {_MULTI}, {PER_CLASS_SQL}
    SELECT round(avg(pr), 6) AS precision, round(avg(re), 6) AS recall, round(avg(f), 6) AS f1 FROM sc""",
)
def metrics_macro(spark, sf_dir):
    return _rounded(cl.macro_metrics(cl.confusion(_predicted(spark, sf_dir), "label", "pred")))


@query(
    "metrics_weighted",
    f"""WITH {_MULTI}, {PER_CLASS_SQL}
    SELECT round(sum(pr * support) / sum(support), 6) AS precision_weighted,
           round(sum(re * support) / sum(support), 6) AS recall_weighted,
           round(sum(f * support) / sum(support), 6) AS f1_weighted FROM sc""",
)
def metrics_weighted(spark, sf_dir):
    return _rounded(cl.weighted_metrics(cl.confusion(_predicted(spark, sf_dir), "label", "pred")))


@query(
    "auc_hard",
    f"""WITH {_BINARY}, {PER_CLASS_SQL} SELECT round(avg(re), 6) AS auc, NULL::VARCHAR AS reason FROM sc""",
)
def auc_hard(spark, sf_dir):
    area = cl.auc_hard(cl.confusion(view(spark, sf_dir, "v_pred"), "label", "pred"))
    return _rounded(area, "reason")


@query(
    "auc_rank",
    """WITH s AS (SELECT l_extendedprice AS score, count(*) FILTER (l_returnflag = 'R') AS pos,
                         count(*) FILTER (l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1),
    c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM s)
    SELECT round(sum(pos::DOUBLE * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS auc,
           NULL::VARCHAR AS reason FROM c""",
)
def auc_rank(spark, sf_dir):
    scored = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice"
    )
    return _rounded(cl.auc_rank(scored, "label", "l_extendedprice"), "reason")


@query(
    "eval_logloss",
    f"""WITH {LOGITS_SQL}
    SELECT round(avg(ln(list_sum(list_transform(logits, lambda z: exp(z - list_max(logits)))))
                     + list_max(logits) - logits[label + 1]), 6) AS loss FROM v_logits""",
)
def eval_logloss(spark, sf_dir):
    return _rounded(cl.log_loss(logits(spark, sf_dir), "logits", "label"))


@query(
    "eval_exclude_class",
    f"""WITH {LOGITS_SQL}, p AS (
        SELECT label, (list_position(logits, list_max(logits)) - 1)::INTEGER AS pred FROM v_logits WHERE label <> 9),
    {PER_CLASS_SQL}
    SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(avg(f), 6) AS f1,
           round(sum(f * support) / sum(support), 6) AS f1_weighted FROM sc""",
)
def eval_exclude_class(spark, sf_dir):
    kept = cl.exclude_class(_predicted(spark, sf_dir), "label", 9)
    counts = cl.confusion(kept, "label", "pred")
    return _rounded(cl.MetricRegistry().compute(counts, ["accuracy", "f1", "f1_weighted"]))


@query(
    "udaf_custom_metric",
    f"""WITH {_MULTI}, {PER_CLASS_SQL}
    SELECT round(avg(re) FILTER (support > 0), 6) AS balanced_accuracy,
           round((sum(hits) * sum(support) - sum(support * predicted))
                 / (sum(support)::DOUBLE * sum(support) - sum(support * predicted)), 6) AS kappa FROM sc""",
)
def udaf_custom_metric(spark, sf_dir):
    """Two user metrics: mean recall of the true classes, and agreement beyond chance."""
    registry = cl.MetricRegistry()
    recall = F.col("hits") / F.when(F.col("support") > 0, F.col("support"))
    registry.add("balanced_accuracy", lambda: F.avg(recall))
    chance = F.sum(F.col("support") * F.col("predicted"))
    total = F.sum("support")
    registry.add(
        "kappa", lambda: (F.sum("hits") * total - chance) / (total.cast("double") * total - chance)
    )
    counts = cl.confusion(_predicted(spark, sf_dir), "label", "pred")
    return _rounded(registry.compute(counts, ["balanced_accuracy", "kappa"]))


@query(
    "pred_ref_align",
    f"""WITH {view_sql("v_pred", "v_texts")}
    SELECT t.doc_id, t.label, p.pred FROM v_texts t JOIN v_pred p ON t.doc_id = p.doc_id WHERE t.text IS NOT NULL""",
)
def pred_ref_align(spark, sf_dir):
    """Predictions exist for every row, references only for complete ones."""
    predictions = view(spark, sf_dir, "v_pred").select("doc_id", "pred")
    references = view(spark, sf_dir, "v_texts").dropna(subset=["text"]).select("doc_id", "label")
    return cl.align(predictions, references, "doc_id").select("doc_id", "label", "pred")


@query(
    "auc_one_vs_rest",
    f"""WITH {LOGITS_SQL},
    flat AS (SELECT label, unnest(range(10))::INTEGER AS cls, unnest(logits) AS score FROM v_logits),
    ranked AS (SELECT cls, label = cls AS own,
                      rank() OVER (PARTITION BY cls ORDER BY score)
                      + (count(*) OVER (PARTITION BY cls, score) - 1) / 2.0 AS place
               FROM flat),
    sums AS (SELECT cls, count(*) FILTER (own) AS support, count(*) FILTER (NOT own) AS others,
                    sum(place) FILTER (own) AS places
             FROM ranked GROUP BY cls)
    SELECT cls, support,
           CASE WHEN support > 0 AND others > 0
                THEN round((places - support * (support + 1) / 2.0) / (support::DOUBLE * others), 6) END AS auc
    FROM sums""",
)
def auc_one_vs_rest(spark, sf_dir):
    """The rank area of every class's score against the rest."""
    areas = cl.auc_one_vs_rest(logits(spark, sf_dir), "label", "logits")
    return areas.select("cls", "support", F.round("auc", 6).alias("auc"))
