"""The corpus operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (
    bpe, chat, chunk_dedup, hard_negatives, jaccard_join, language_id, packing, quality, suffix_dedup, token_file, topk, warc, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER_FILE, RANKS_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_query()
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    manifest = token_file.write_documents(docs, tokenizer_path(TOKENIZER_FILE))
    return token_file.read_documents(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@_query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learns = language_id.training_row(F.col("doc_id"))
    model = language_id.fit(docs.where(learns))
    return language_id.predict(docs.select("doc_id", "text", (~learns).alias("held_out")), model)


@_query()
def op5_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.with_crc32(packing.pack_documents(docs, tokenizer_path(TOKENIZER_FILE)))


@_query("""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
    SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
""")
def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    index = warc.write_archive(pages)
    return warc.look_up(warc.capture_keys(pages), index)


@_query("""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.c, c.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
""")
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@_query("""
WITH g AS (
    SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
FROM documents d JOIN g ON coalesce(d.text, '') = g.t
""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(_table(spark, sf_dir, "documents", "doc_id", "text"))


# A reader of the format that is fed by SQL alone: the same digests from the turns themselves.
@_query("""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), e AS (
    SELECT *, length(replace(replace(replace(text, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t')) AS n,
           length(replace(replace(replace(replace(role, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t'), chr(10), '\\n')) AS r,
           row_number() OVER w AS place, lag(role) OVER w AS before
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + 7 + CASE WHEN before IS NULL OR before <> role THEN r + 6 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    control = spark.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(control)))


@_query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(docs, "doc_id", "text", tokenizer_path(RANKS_FILE))


@_query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@_query()
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    labels = _table(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("label"))
    # The column's magnitude is what may generalise.
    docs = docs.withColumn("n_chars", F.floor(F.log2(F.col("n_chars") + 1)))
    learns = quality.training_row(F.col("doc_id"))
    model = quality.fit(docs, labels.where(learns), ["n_chars"])
    held_out = F.coalesce(~learns, F.lit(False)).alias("held_out")
    return quality.score(docs.select("doc_id", "text", "n_chars", held_out), model, ["doc_id", "held_out"], ["n_chars"])


@_query("""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.c, c.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 10
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
