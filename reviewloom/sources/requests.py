"""Scoring requests and responses as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two request shapes: plain texts, and texts below Inputs with an optional parameter.
PLAIN_REQUEST = "data array<struct<text:string>>"
NESTED_REQUEST = "Inputs struct<data:array<struct<reviewText:string>>>, GlobalParameters double"

UNREADABLE = "unreadable request"


def parse_requests(requests: DataFrame, raw: str = "raw", key: str = "request_id") -> DataFrame:
    """One row per text with its position; takes both shapes.

    A request without texts is one row without a position; ``error`` says so if its body is unreadable.
    """
    plain = F.from_json(F.col(raw), PLAIN_REQUEST)
    nested = F.from_json(F.col(raw), NESTED_REQUEST)
    texts = F.coalesce(
        F.transform(plain["data"], lambda item: item["text"]),
        F.transform(nested["Inputs"]["data"], lambda item: item["reviewText"]),
    )
    return requests.select(
        key,
        F.coalesce(nested["GlobalParameters"], F.lit(1.0)).alias("global_parameter"),
        F.when(texts.isNull(), F.lit(UNREADABLE)).alias("error"),
        F.posexplode_outer(texts).alias("pos", "text"),
    )


def _replies(scored: DataFrame, value: Column, key: str) -> Column:
    placed = F.when(F.col("pos").isNotNull(), F.struct(F.col("pos"), value.alias("value")))
    return F.transform(
        F.sort_array(F.collect_list(placed)),
        lambda item: item["value"],
    )


def responses(scored: DataFrame, value: str = "prediction", key: str = "request_id") -> DataFrame:
    """One JSON list per request, in request order, null where there was no text; empty without texts.

    A request is one input row, so its reply is no longer than that row's list of texts.
    """
    replies = _replies(scored, F.col(value), key)
    return scored.groupBy(key).agg(
        F.to_json(replies, {"ignoreNullFields": "false"}).alias("response"),
        F.size(replies).alias("n_items"),
    )


def result_responses(
    scored: DataFrame, value: str = "prediction", key: str = "request_id"
) -> DataFrame:
    """The second reply shape: ``{"Results": [...]}`` with every prediction as a string."""
    replies = _replies(scored, F.col(value).cast("string"), key)
    return scored.groupBy(key).agg(
        F.to_json(F.struct(replies.alias("Results"))).alias("response"),
        F.size(replies).alias("n_items"),
    )
