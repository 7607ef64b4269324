"""Vocabularies, token ids and padded mini-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.tokens import MAX_LENGTH, SPECIAL_TOKENS, model_input, words
from reviewloom.operators.encoding import encode_labels
from reviewloom.plans.joins import frequency_join
from reviewloom.plans.ordering import hash_ordered_index, sorted_index
from reviewloom.plans.storage import materialise


def tokenize(df: DataFrame, text: str, max_length: int | None = MAX_LENGTH) -> DataFrame:
    return df.withColumn("tokens", model_input(F.col(text), max_length))


def token_counts(df: DataFrame, text: str) -> DataFrame:
    return (
        df.select(F.explode(words(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequent_counts(df: DataFrame, text: str, size: int, tracked: int) -> DataFrame | None:
    """(token, n) of candidates that provably hold the ``size`` most frequent tokens, exactly counted; else None.

    A mergeable sketch of ``tracked`` tokens names the candidates, so tasks send no more than that whatever the
    number of tokens; only the candidates are then counted. A token that the sketch does not name occurs at
    most 7 / ``tracked`` of all times, or not more often than the last one named when it names as many as it may. If
    the last token wanted does not occur more often than that, nothing is proven.
    """
    tokens = df.select(F.explode(words(F.col(text))).alias("token"))
    named = min(tracked, 2 * size + 1000)
    sketch = tokens.agg(F.expr(f"approx_top_k(token, {named}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    sketched = materialise(sketch)
    candidates = materialise(sketched.select(F.explode("top").alias("c")).select("c.item", "c.count"))
    total, found, last = (
        sketched.first()["n"], *candidates.agg(F.count(F.lit(1)), F.coalesce(F.min("count"), F.lit(0))).first(),
    )
    if found < size:
        return None
    bound = max(7 * total / tracked, last if found == named else 0)
    # As many rows as the sketch names at most.
    own = F.broadcast(candidates.select(F.col("item").alias("token")))
    counts = materialise(tokens.join(own, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    least = counts.orderBy(F.col("n").desc()).limit(size).agg(F.min("n")).first()[0]
    return counts if least is not None and least > bound else None


def build_vocabulary(df: DataFrame, text: str, size: int, tracked: int | None = None) -> DataFrame:
    """The special tokens and the ``size`` most frequent tokens; ties go by token.

    With ``tracked`` the counts come from a sketch of so many tokens and a recount, where that proves them;
    otherwise, and where it does not, every token is counted. The result is the same.
    """
    order = [F.col("n").desc(), F.col("token")]
    first = len(SPECIAL_TOKENS)
    counts = frequent_counts(df, text, size, tracked) if tracked else None
    counts = token_counts(df, text) if counts is None else counts
    frequent = counts.orderBy(*order).limit(size)
    numbered = sorted_index(frequent, [], order, "place")
    special = df.sparkSession.createDataFrame(
        list(SPECIAL_TOKENS.items()), "token string, id bigint"
    )
    return special.unionByName(
        numbered.select("token", (F.col("place") + first).cast("bigint").alias("id"))
    )


def extend_vocabulary(vocabulary: DataFrame, tokens: DataFrame, seed: int = 0) -> DataFrame:
    """Adds the tokens the vocabulary lacks; their ids go on from its largest, in hash order."""
    vocabulary = materialise(vocabulary)
    new = tokens.select("token").distinct().join(vocabulary, "token", "left_anti")
    largest = vocabulary.agg(F.max("id")).first()[0]
    numbered = hash_ordered_index(new, "token", seed, out="place")
    return vocabulary.select("token", "id").unionByName(
        numbered.select("token", (F.col("place") + largest + 1).alias("id"))
    )


def _met(
    df: DataFrame, carried: list[str], text: str, vocabulary: DataFrame, max_length: int | None
) -> DataFrame:
    """Every model input token with its place and id; tokens outside the vocabulary become [UNK]."""
    placed = df.select(*carried, F.posexplode(model_input(F.col(text), max_length)).alias("pos", "token"))
    stored = materialise(vocabulary.select("token", "id"))
    # Ids grow as tokens get rarer.
    found = frequency_join(placed, stored, "token", 1 / (F.col("id") + 1))
    unknown = F.lit(SPECIAL_TOKENS["[UNK]"]).cast("bigint")
    return found.withColumn("id", F.coalesce("id", unknown).cast("int"))


def padded_batches(
    df: DataFrame,
    key: str,
    text: str,
    vocabulary: DataFrame,
    batch_size: int,
    max_length: int | None = MAX_LENGTH,
    seed: int = 0,
) -> DataFrame:
    """(key, batch_id, input_ids, attention_mask) as of ``mini_batches`` and ``pad_batches`` on ``token_ids``.

    The batch is known before a text is cut into tokens, so ids are shuffled once, to their batch. That has at
    most ``batch_size`` rows of at most ``max_length`` tokens.
    """
    numbered = mini_batches(df.select(key), key, batch_size, seed).select(key, "batch_id")
    found = _met(df.select(key, text).join(numbered, key), [key, "batch_id"], text, vocabulary, max_length)
    gathered = found.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct(key, "pos", "id"))).alias("__all"))
    # A row begins where its place 0 stands.
    size = F.size("__all")
    starts = F.filter(F.sequence(F.lit(1), size), lambda i: F.element_at("__all", i)["pos"] == 0)
    ends = F.concat(F.slice("__starts", F.lit(2), F.greatest(F.size("__starts") - 1, F.lit(0))), F.array(size + 1))
    rows = F.transform(
        F.arrays_zip("__starts", "__ends"),
        lambda r: F.struct(
            F.element_at("__all", r["__starts"])[key].alias(key),
            F.transform(F.slice("__all", r["__starts"], r["__ends"] - r["__starts"]), lambda t: t["id"]).alias("ids"),
        ),
    )
    each = (
        gathered.withColumn("__starts", starts)
        .withColumn("__ends", ends)
        .withColumn("__rows", rows)
        .withColumn("__longest", F.array_max(F.transform("__rows", lambda r: F.size(r["ids"]))))
        .select("batch_id", "__longest", F.inline("__rows"))
    )
    gap = F.col("__longest") - F.size("ids")
    pad = F.lit(SPECIAL_TOKENS["[PAD]"])
    return each.select(
        key,
        "batch_id",
        F.concat("ids", F.array_repeat(pad, gap)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), gap)).alias("attention_mask"),
    )


def token_ids(
    df: DataFrame, key: str, text: str, vocabulary: DataFrame, max_length: int | None = MAX_LENGTH
) -> DataFrame:
    """(key, input_ids, attention_mask); tokens outside the vocabulary become [UNK].

    A row's tokens start in one task and are gathered there before the exchange, so what is
    shuffled is one id list per row, no longer than the row's text.
    """
    found = _met(df, [key], text, vocabulary, max_length)
    gathered = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("__ids"))
    ids = F.transform("__ids", lambda item: item["id"])
    return gathered.select(
        key, ids.alias("input_ids"), F.array_repeat(F.lit(1), F.size("__ids")).alias("attention_mask")
    )


def mini_batches(df: DataFrame, key: str, batch_size: int, seed: int = 0) -> DataFrame:
    """Adds the batch of each row in a seeded random order."""
    return hash_ordered_index(df, key, seed).withColumn(
        "batch_id", F.floor(F.col("row_index") / batch_size).cast("bigint")
    )


def pad_batches(batches: DataFrame) -> DataFrame:
    """Pads ids and masks to the longest row of the batch; a batch has batch_size rows at most."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    gap = F.col("__longest") - F.size("input_ids")
    pad = F.lit(SPECIAL_TOKENS["[PAD]"])
    return (
        batches.withColumn("__longest", longest)
        .withColumn("attention_mask", F.concat("attention_mask", F.array_repeat(F.lit(0), gap)))
        .withColumn("input_ids", F.concat("input_ids", F.array_repeat(pad, gap)))
        .drop("__longest")
    )


def encoded_dataset(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    label_map: DataFrame,
    vocabulary: DataFrame,
    max_length: int | None = MAX_LENGTH,
) -> DataFrame:
    """Complete rows with label index, token ids and mask."""
    complete = df.select(key, text, label).dropna(how="any")
    encoded = encode_labels(complete.select(key, label), label_map, label)
    ids = token_ids(complete, key, text, vocabulary, max_length)
    return encoded.join(ids, key)
