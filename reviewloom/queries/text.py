"""Tokens, vocabularies and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import encoding, vocabulary
from reviewloom.operators.scoring import map_text
from reviewloom.plans.storage import spread
from reviewloom.queries.base import query
from reviewloom.queries.views import documents, table, tokens_sql, view, view_sql

VOCABULARY = 5_000
BATCH = 8

_INPUT = f"list_concat(list_concat(['[CLS]'], {tokens_sql('text')}[1:510]), ['[SEP]'])"


def _vocab_sql(size):
    return f"""counted AS (
    SELECT token, count(*) AS n FROM (SELECT unnest({tokens_sql('text')}) AS token FROM documents) GROUP BY token),
vocab AS (SELECT * FROM (VALUES ('[PAD]', 0::BIGINT), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3)) t(token, id)
          UNION ALL
          SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 FROM counted
          QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {size})"""


_VOCAB = _vocab_sql(VOCABULARY)


def _ids_sql(source):
    return f"""placed AS (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos
           FROM (SELECT doc_id, {_INPUT} AS toks FROM {source})),
ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS input_ids
        FROM placed p LEFT JOIN vocab v ON v.token = p.token GROUP BY doc_id)"""


def _joined(column):
    return F.md5(F.array_join(F.transform(column, lambda x: x.cast("string")), ","))


def _vocabulary(spark, sf_dir):
    return vocabulary.build_vocabulary(documents(spark, sf_dir), "text", VOCABULARY)


@query(
    "tokenize_truncate",
    f"""SELECT doc_id, len(toks)::INTEGER AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens
    FROM (SELECT doc_id, {_INPUT} AS toks FROM documents)""",
)
def tokenize_truncate(spark, sf_dir):
    return vocabulary.tokenize(documents(spark, sf_dir), "text").select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens")
    )


@query("vocab_build", f"WITH {_VOCAB} SELECT token, id FROM vocab")
def vocab_build(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


TOP = 200


@query("vocab_top", f"WITH {_vocab_sql(TOP)} SELECT token, id FROM vocab")
def vocab_top(spark, sf_dir):
    """A small vocabulary, whose counts come from a sketch and a recount of its candidates."""
    return vocabulary.build_vocabulary(documents(spark, sf_dir), "text", TOP, tracked=500_000)


@query(
    "vocab_extend",
    f"""WITH {_VOCAB}, fresh AS (
        SELECT DISTINCT token FROM (SELECT unnest({tokens_sql('text')}) AS token FROM conversations)
        WHERE token NOT IN (SELECT token FROM vocab))
    SELECT token, id FROM vocab UNION ALL
    SELECT token, (SELECT max(id) FROM vocab) + row_number() OVER (ORDER BY md5('0:' || token), token) FROM fresh""",
)
def vocab_extend(spark, sf_dir):
    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "turn")
    spoken = vocabulary.token_counts(turns, "text")
    return vocabulary.extend_vocabulary(_vocabulary(spark, sf_dir), spoken)


@query(
    "token_ids",
    f"""WITH {_VOCAB}, {_ids_sql('documents')}
    SELECT doc_id, len(input_ids)::INTEGER AS n_ids, md5(array_to_string(input_ids, ',')) AS input_ids,
           len(input_ids) AS mask_total FROM ids""",
)
def token_ids(spark, sf_dir):
    ids = vocabulary.token_ids(documents(spark, sf_dir), "doc_id", "text", _vocabulary(spark, sf_dir))
    total = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return ids.select(
        "doc_id",
        F.size("input_ids").alias("n_ids"),
        _joined(F.col("input_ids")).alias("input_ids"),
        total.alias("mask_total"),
    )


_BATCHES = f"""rows AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) - 1 AS row_index FROM documents),
batches AS (SELECT doc_id, row_index, row_index // {BATCH} AS batch_id FROM rows)"""


@query("mini_batches", f"WITH {_BATCHES} SELECT doc_id, row_index, batch_id FROM batches")
def mini_batches(spark, sf_dir):
    return vocabulary.mini_batches(documents(spark, sf_dir).select("doc_id"), "doc_id", BATCH)


@query(
    "pad_batches",
    f"""WITH {_VOCAB}, {_ids_sql('documents')}, {_BATCHES},
    sized AS (SELECT b.doc_id, batch_id, input_ids, max(len(input_ids)) OVER (PARTITION BY batch_id) AS longest
              FROM batches b JOIN ids i ON b.doc_id = i.doc_id)
    SELECT doc_id, batch_id, longest::INTEGER AS n_ids, len(input_ids) AS mask_total,
           md5(array_to_string(list_resize(input_ids, longest, 0::BIGINT), ',')) AS input_ids FROM sized""",
)
def pad_batches(spark, sf_dir):
    batches = vocabulary.padded_batches(
        documents(spark, sf_dir), "doc_id", "text", _vocabulary(spark, sf_dir), BATCH
    )
    total = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return batches.select(
        "doc_id",
        "batch_id",
        F.size("input_ids").alias("n_ids"),
        total.alias("mask_total"),
        _joined(F.col("input_ids")).alias("input_ids"),
    )


@query(
    "encoded_dataset",
    f"""WITH {view_sql("v_texts")}, {_VOCAB}, {_ids_sql("(SELECT * FROM v_texts WHERE text IS NOT NULL)")},
    m AS (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM v_texts))
    SELECT t.doc_id, m.idx AS labels, len(input_ids)::INTEGER AS n_ids, md5(array_to_string(input_ids, ',')) AS input_ids
    FROM v_texts t JOIN m ON m.label = t.label JOIN ids ON ids.doc_id = t.doc_id""",
)
def encoded_dataset(spark, sf_dir):
    texts = view(spark, sf_dir, "v_texts")
    label_map = encoding.fit_label_map(texts, "label")
    encoded = vocabulary.encoded_dataset(
        texts, "doc_id", "text", "label", label_map, _vocabulary(spark, sf_dir)
    )
    return encoded.select(
        "doc_id", "labels", F.size("input_ids").alias("n_ids"), _joined(F.col("input_ids")).alias("input_ids")
    )


@query(
    "udf_batched_map",
    """SELECT doc_id, length(text) AS n_chars, len(regexp_extract_all(text, '[A-Za-z0-9]+')) AS n_words
    FROM documents""",
)
def udf_batched_map(spark, sf_dir):
    """A user's own tokenizer, applied to Arrow batches."""

    def count_words(frame):
        return frame[["doc_id"]].assign(
            n_chars=frame["text"].str.len(), n_words=frame["text"].str.count("[A-Za-z0-9]+")
        )

    return map_text(documents(spark, sf_dir), count_words, "doc_id bigint, n_chars bigint, n_words bigint")
