"""Nearest class centroid on dense vectors."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.centroid_blocks import predict_in_blocks
from reviewloom.plans.joins import small_rows


def fit_centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, centroid): one mean vector per class, as partial sums per task."""
    dense = df.select(
        F.col(label).alias("label"),
        array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"),
    )
    return dense.groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("centroid"))


def predict_centroid(
    df: DataFrame, vector: str, centroids: DataFrame, carried: Sequence[str] = ()
) -> DataFrame:
    """Adds the class of the nearest centroid and the squared distance; ties go to the smaller label.

    The model is one vector per class, held by every task while there are few; rows are then compared
    in Arrow batches, so the table is neither joined nor shuffled. More classes than the driver should
    hold give the same result by :func:`centroid_blocks.predict_in_blocks`.
    """
    import numpy as np

    rows = small_rows(centroids)
    if rows is None:
        return predict_in_blocks(df, vector, centroids, carried)
    model = sorted((row["label"], row["centroid"]) for row in rows)
    labels = np.array([m[0] for m in model])
    means = np.array([m[1] for m in model], dtype="float64")
    label_type = centroids.schema["label"].dataType.simpleString()

    @F.pandas_udf(f"pred {label_type}, distance double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        if len(vectors) == 0:
            return pd.DataFrame({"pred": labels[:0], "distance": means[:0, 0]})
        rows = np.stack(vectors.to_numpy()).astype("float64")
        best = np.zeros(len(rows), dtype="int64")
        shortest = np.full(len(rows), np.inf)
        for place, mean in enumerate(means):
            distance = ((rows - mean) ** 2).sum(axis=1)
            closer = distance < shortest
            best[closer] = place
            shortest[closer] = distance[closer]
        return pd.DataFrame({"pred": labels[best], "distance": shortest})

    return df.select(*carried, nearest(F.col(vector)).alias("n")).select(*carried, "n.*")
