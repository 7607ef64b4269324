"""Tokenisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The special tokens with their ids, and the longest model input they are part of.
SPECIAL_TOKENS = {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3}
MAX_LENGTH = 512
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def words(text: Column) -> Column:
    """All tokens of the whole text: runs of letters and digits, and single other marks. Cased."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def model_input(text: Column, max_length: int | None = MAX_LENGTH) -> Column:
    """Tokens between [CLS] and [SEP]; truncation to the model's input length is the feature."""
    body = words(text)
    if max_length is not None:
        body = F.slice(body, 1, max_length - 2)
    return F.concat(F.array(F.lit("[CLS]")), body, F.array(F.lit("[SEP]")))
