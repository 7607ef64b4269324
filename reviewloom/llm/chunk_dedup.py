"""Exact duplicates by content-defined chunk recipes.

Each text is cut where a rolling hash of its last bytes says so, hence equal texts are cut alike and a long
text moves as a short list. Chunks get identifiers: a 64-bit fingerprint, verified by SHA-256 over all chunks;
where one fingerprint has several digests its chunks are told apart by an ordinal. Texts are equal when their
ordered identifier lists are. Lists are compared and counted with partial sums before the exchange, so a group
with most of the rows is a few rows per task.

Null and empty texts are equal to each other (an empty list). Of equal texts the row with the largest id
stays; repeated rows of one id and text are one document and share the decision. Rows without an id are
dropped in favour of any row that has one. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.columns import gives_back, slices, unused, utf8
from reviewloom.plans.storage import materialise

MIN_CHUNK, CUT_BITS, MAX_CHUNK = 512, 11, 16384
WINDOW = 32
TEXTS_AT_ONCE = 256


def _gear() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint32)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Places where the rolling hash of the last 32 bytes allows a cut."""
    h = _gear()[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1


def chunk_ends(cuts: np.ndarray, start: int, stop: int) -> list[int]:
    """Ends of the chunks of one text; each but the last has MIN_CHUNK to MAX_CHUNK bytes."""
    ends: list[int] = []
    if stop - start > MIN_CHUNK:
        at = start
        for cut in cuts[np.searchsorted(cuts, start + MIN_CHUNK) : np.searchsorted(cuts, stop)].tolist():
            while cut - at > MAX_CHUNK:
                at += MAX_CHUNK
                ends.append(at)
            if cut - at >= MIN_CHUNK:
                at = cut
                ends.append(at)
        while stop - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
    if stop > (ends[-1] if ends else start):
        ends.append(stop)
    return ends


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, n_bytes, chunks) of every row; a chunk is (fp, digest)."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, TEXTS_AT_ONCE)):
            data, offsets = utf8(batch.column(1))
            cuts = cut_points(data) if len(data) else np.zeros(0, np.int64)
            text = memoryview(data.tobytes())
            fps, digests, sizes, wholes = [], [], [], []
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                ends = chunk_ends(cuts, a, b)
                for s, e in zip([a, *ends], ends):
                    fps.append(xxhash.xxh3_64_intdigest(text[s:e]))
                    digests.append(sha256(text[s:e]).digest())
                sizes.append(len(ends))
                wholes.append(sha256(text[a:b]).hexdigest())
            at = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=at[1:])
            fp = np.array(fps, np.uint64).view(np.int64) if fps else np.zeros(0, np.int64)
            chunks = pa.StructArray.from_arrays([pa.array(fp), pa.array(digests, pa.binary())], ["fp", "digest"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(wholes, pa.string()),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(at), chunks),
                ],
                names=["doc_id", "text_sha256", "n_bytes", "chunks"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, text_sha256 string, n_bytes long, chunks array<struct<fp: bigint, digest: binary>>",
    )


def identified(stored: DataFrame) -> DataFrame:
    """Recipes with ``ids``, the ordered list of verified chunk identifiers, in place of the chunks."""
    clashing = (
        stored.select(F.explode("chunks").alias("c"))
        .groupBy("c.fp")
        .agg(F.min("c.digest").alias("low"), F.max("c.digest").alias("high"))
        .where("low <> high")
        .select("fp")
    )
    clashing = materialise(clashing)
    plain = F.transform("chunks", lambda c: F.struct(c["fp"].alias("fp"), F.lit(0).alias("ordinal")))
    if clashing.isEmpty():
        return stored.withColumn("ids", plain).drop("chunks")
    chunks = stored.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "c")).select(
        "doc_id", "text_sha256", "pos", "c.fp", "c.digest"
    )
    several = chunks.join(clashing, "fp", "left_semi")
    ordinals = several.select("fp", "digest").distinct().withColumn(
        "ordinal", F.row_number().over(Window.partitionBy("fp").orderBy("digest"))
    )
    told = (
        chunks.distinct()
        .join(ordinals, ["fp", "digest"], "left")
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "fp", F.coalesce("ordinal", F.lit(0)).alias("ordinal")))).alias("l"))
        .select(
            F.col("doc_id").alias("key_id"),
            F.col("text_sha256").alias("key_sha"),
            F.transform("l", lambda c: F.struct(c["fp"].alias("fp"), c["ordinal"].alias("ordinal"))).alias("ids"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("text_sha256") == F.col("key_sha"))
    empty = F.array().cast("array<struct<fp: bigint, ordinal: int>>")
    return (
        stored.drop("chunks")
        .join(told, same, "left")
        .withColumn("ids", F.coalesce("ids", empty))
        .drop("key_id", "key_sha")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    stored = identified(materialise(recipes(docs)))
    groups = stored.groupBy("ids").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return stored.join(groups, "ids").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone_id, gone_sha = (unused(name, docs.columns) for name in ("_gone_id", "_gone_sha"))
    dropped = exact_groups(docs.select("doc_id", "text")).where(~F.col("kept")).select(
        F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha)
    )
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256) == F.col(gone_sha)
    )
    return docs.join(dropped, same, "left_anti")
