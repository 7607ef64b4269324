"""From raw documents to packed training sequences, one table after the other.

Every stage takes the rows that the stage before kept and returns the columns of documents; the last returns the
pieces of the packed sequences. Stage outputs are written as Parquet and read again, so a lost executor costs at
most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import chunk_dedup, jaccard_join, language_id, packing, suffix_dedup
from reviewloom.llm.queries import TOKENIZER_FILE, tokenizer_path
from reviewloom.plans.storage import materialise


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language can be told: null texts and texts without a letter."""
    learns = language_id.training_row(F.col("doc_id"))
    model = language_id.fit(docs.select("doc_id", "text", "lang").where(learns))
    return language_id.keep_identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return chunk_dedup.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts, the document with the smallest doc_id stays."""
    return jaccard_join.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out of every text what an earlier place has as well; every document stays."""
    return suffix_dedup.clean(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, with their ids."""
    return packing.pack_documents(docs, tokenizer_path(TOKENIZER_FILE))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Suffix sorting and packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents below ``sf_dir``."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        rows = materialise(stage(spark, rows, sf_dir))
    return rows
