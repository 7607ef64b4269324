"""Batch scoring of JSON requests, and user functions over text batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators import bayes
from reviewloom.operators.encoding import decode_labels
from reviewloom.sources.requests import parse_requests


def predict_texts(texts: DataFrame, model: bayes.NaiveBayes) -> DataFrame:
    """(__key, pred) for parsed requests, the key being request_id and pos; a missing text has no prediction."""
    keyed = texts.select(
        F.struct("request_id", "pos").alias("__key"), F.col("text").isNotNull().alias("__given"), "text"
    )
    return bayes.predict(keyed, "__key", "text", model, ["__given"]).select(
        "__key", F.when(F.col("__given"), F.col("pred")).alias("pred")
    )


def named_texts(predicted: DataFrame, label_map: DataFrame) -> DataFrame:
    """(request_id, pos, prediction) of what ``predict_texts`` found; an index that the map lacks has no prediction."""
    decoded = decode_labels(predicted, label_map, "pred")
    return decoded.select("__key.request_id", "__key.pos", "prediction")


def score_texts(texts: DataFrame, model: bayes.NaiveBayes, label_map: DataFrame) -> DataFrame:
    """(request_id, pos, prediction) for parsed requests; a missing text has no prediction."""
    return named_texts(predict_texts(texts, model), label_map)


def score_requests(
    requests: DataFrame, model: bayes.NaiveBayes, label_map: DataFrame, raw: str = "raw"
) -> DataFrame:
    """Parses, scores and decodes any number of requests; one row per text."""
    return score_texts(parse_requests(requests, raw), model, label_map)


def map_text(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Applies a user's batch function to Arrow batches of the table, without a shuffle."""

    def batches(frames):
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(batches, schema)
