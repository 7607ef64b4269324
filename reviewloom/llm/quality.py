"""Quality of texts by a factorisation machine.

The features of a text are its hashed words (lower-cased, without punctuation at the ends; 1 + log of the count, scaled to
length 1), statistics of its structure, each as a value from 0 to 1 and as the bin it falls into, and metadata
columns, each as one hashed value. The machine adds a weight per feature and, for every pair of features, the
product of their vectors of ``RANK`` factors. The sum over all pairs is taken in linear time as half of the
squared sum less the sum of squares, factor by factor.

It is fitted on about ``SAMPLE_ROWS`` labelled rows, taken by a hash of the id. They are dealt to a fixed number of
shards; in each round a task a shard goes once through its rows from the common parameters, which are then averaged.
All sizes are fixed, so neither the model nor what tasks send grows with the data.

A null text is an empty one; it has statistics, and hence a score, like any other. Rows without id or label are not
learned from, equal rows (id, text and label) only once; every row is scored for itself. Without a single labelled row every score is 0.5.
A null metadata value is a value of its own. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.storage import materialise

SAMPLE_ROWS = 20_000
SHARDS, ROUNDS, BATCH = 8, 8, 64
RANK = 8
WORD_BUCKETS, METADATA_BUCKETS, BINS = 1 << 14, 1 << 10, 8
RATE, SHRINK = 0.1, 1e-5
CACHED_TOKENS = 200_000
STATISTICS = (
    "characters", "tokens", "distinct", "most common", "repeats", "token length", "capital tokens", "marked tokens",
    "number tokens", "lines", "repeated lines", "lower", "upper", "digits", "spaces", "marks", "other bytes",
)
_VALUE_AT = WORD_BUCKETS + METADATA_BUCKETS
_BIN_AT = _VALUE_AT + len(STATISTICS)
FEATURES = _BIN_AT + BINS * len(STATISTICS)

_EDGES = re.compile(r"^\W+|\W+$")
_CLASSES = np.full(256, 5)
_CLASSES[[9, 10, 13, 32]] = 3
_CLASSES[33:127] = 4
_CLASSES[48:58], _CLASSES[65:91], _CLASSES[97:123] = 2, 1, 0


class Tokens(dict):
    """By token its bucket (-1 without letters or digits), length, and whether it is in capitals, ends in a mark, has a digit."""

    def __init__(self):
        super().__init__()
        self.rows = np.zeros((CACHED_TOKENS, 5))

    def __missing__(self, token: str) -> int:
        if len(self) == CACHED_TOKENS:
            raise OverflowError
        at = self[token] = len(self)
        word = _EDGES.sub("", token).lower()
        bucket = zlib.crc32(word.encode()) % WORD_BUCKETS if word else -1
        capital = len(word) > 1 and token.isupper()
        self.rows[at] = bucket, len(token), capital, not token[-1].isalnum(), any(map(str.isdigit, token))
        return at

    def look_up(self, tokens: list[str]) -> np.ndarray:
        try:
            return self.rows[list(map(self.__getitem__, tokens))]
        except OverflowError:
            self.clear()
        found = []
        for k in range(0, len(tokens), CACHED_TOKENS):
            self.clear()
            found.append(self.rows[list(map(self.__getitem__, tokens[k : k + CACHED_TOKENS]))])
        return np.concatenate(found)


def features(text: str | None, metadata: tuple, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places and values; places of words may repeat, their values add."""
    text = text or ""
    said = text.split()
    counts = Counter(said)
    n = len(said)
    times = np.fromiter(counts.values(), np.float64, len(counts))
    about = tokens.look_up(list(counts)) if n else np.zeros((0, 5))
    lines = text.split("\n")
    kinds = np.bincount(_CLASSES, weights=np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256), minlength=6)
    means = times @ about[:, 1:] / max(n, 1)
    statistics = [
        math.log1p(len(text)) / 16,
        math.log1p(n) / 14,
        len(counts) / max(n, 1),
        times.max(initial=0) / max(n, 1),
        sum(map(eq, said, said[1:])) / max(n - 1, 1),
        means[0] / (means[0] + 8),
        *means[1:],
        math.log1p(len(lines)) / 10,
        1 - len(set(lines)) / len(lines),
        *(kinds / max(kinds.sum(), 1)),
    ]
    value = np.clip(np.array(statistics), 0, 1)
    words = about[:, 0] >= 0
    weight = 1 + np.log(times[words])
    weight /= max(float(np.sqrt((weight**2).sum())), 1e-12)
    extra = [WORD_BUCKETS + zlib.crc32(f"{k}={x}".encode()) % METADATA_BUCKETS for k, x in enumerate(metadata)]
    k = np.arange(len(value))
    bins = _BIN_AT + BINS * k + np.minimum((BINS * value).astype(np.int64), BINS - 1)
    places = np.concatenate([about[words, 0].astype(np.int64), np.array(extra, np.int64), _VALUE_AT + k, bins])
    return places.astype(np.int32), np.concatenate([weight, np.ones(len(extra)), value, np.ones(len(bins))]).astype(np.float32)


@dataclass
class Model:
    """Weights and factors by feature; the first weight of ``weights`` is the constant."""

    weights: np.ndarray
    factors: np.ndarray

    @staticmethod
    def blank() -> Model:
        return Model(np.zeros(FEATURES + 1), np.zeros((FEATURES, RANK)))

    def margins(self, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A margin a row of features, with the sums and the parts of the pairwise terms."""
        parts = self.factors[places] * values[:, None]
        sums = np.add.reduceat(parts, starts, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(parts**2, starts, axis=0)).sum(axis=1)
        return self.weights[0] + np.add.reduceat(self.weights[places + 1] * values, starts) + pairs, sums, parts


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def epoch(model: Model, seen: Model, rows: list[tuple[np.ndarray, np.ndarray, float]]) -> None:
    """One pass of stochastic descent over ``rows``; ``seen`` holds the sums of squared gradients."""
    for at in range(0, len(rows), BATCH):
        part = rows[at : at + BATCH]
        sizes = np.array([len(p) for p, _, _ in part])
        places, values = np.concatenate([p for p, _, _ in part]), np.concatenate([v for _, v, _ in part]).astype(np.float64)
        starts = np.cumsum(sizes) - sizes
        margin, sums, parts = model.margins(places, values, starts)
        wrong = (probability(margin) - np.array([y for _, _, y in part])) / len(part)
        each = np.repeat(wrong, sizes) * values
        moves = each[:, None] * (np.repeat(sums, sizes, axis=0) - parts)
        slope = np.append(wrong.sum(), np.bincount(places, each, FEATURES)) + SHRINK * model.weights
        turn = np.stack([np.bincount(places, moves[:, k], FEATURES) for k in range(RANK)], axis=1) + SHRINK * model.factors
        seen.weights += slope**2
        seen.factors += turn**2
        model.weights -= RATE * slope / np.sqrt(seen.weights + 1e-8)
        model.factors -= RATE * turn / np.sqrt(seen.factors + 1e-8)


def training_row(doc_id: Column) -> Column:
    """True for rows that may be learned from: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def _sampled(docs: DataFrame, labels: DataFrame, metadata: list[str], rows: int) -> DataFrame:
    """(h, label, places, weights) of about ``rows`` labelled texts."""
    named = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", F.col("label").cast("double").alias("label"))
    named = named.distinct()
    share = min(1.0, rows / max(named.count(), 1))
    # The sample of the labels bounds what is copied to the tasks.
    few = named.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40) < share)
    texts = docs.select("doc_id", F.col("text").alias("t"), F.struct(*metadata).alias("m") if metadata else F.lit(None).cast("string").alias("m"))
    met = texts.join(F.broadcast(few), "doc_id").withColumn("h", F.xxhash64("doc_id", "t", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            found = [features(t, _values(m, metadata), tokens) for t, m in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([p.astype("<i4").tobytes() for p, _ in found], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                ],
                names=["h", "label", "places", "weights"],
            )

    found = met.select("h", "label", "t", "m").mapInArrow(run, "h long, label double, places binary, weights binary")
    stored = materialise(found.dropDuplicates(["h"]))
    # Many texts of one id pass together with it; their own hashes bound them.
    n = stored.count()
    return stored if n <= 2 * rows else stored.where(F.pmod(F.hash("h"), F.lit(1 << 30)) < rows / n * (1 << 30))


def _values(struct: dict | None, names: list[str]) -> tuple:
    return tuple(struct[c] for c in names) if names else ()


def _learner(shared: Broadcast, turn: int) -> Callable[[pa.Table], pa.Table]:
    """One pass over a shard from the shared parameters; what it ends with and its number of rows."""

    def learn(table: pa.Table) -> pa.Table:
        start, sums = shared.value
        model, seen = Model(start.weights.copy(), start.factors.copy()), Model(sums.weights.copy(), sums.factors.copy())
        table = table.sort_by("h")
        rows = [
            (np.frombuffer(p, "<i4"), np.frombuffer(w, "<f4"), y)
            for p, w, y in zip(*(table.column(c).to_pylist() for c in ("places", "weights", "label")))
        ]
        epoch(model, seen, [rows[k] for k in np.random.default_rng(turn).permutation(len(rows))])
        flat = np.concatenate([x.ravel() for x in (model.weights, model.factors, seen.weights, seen.factors)])
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "parameters": pa.array([flat.astype("<f4").tobytes()], pa.binary())})

    return learn


def fit(docs: DataFrame, labels: DataFrame, metadata: list[str] | None = None, rows: int = SAMPLE_ROWS, seed: int = 0) -> Model:
    """A model from documents (doc_id, text, the ``metadata`` columns) and labels (doc_id, label 0 or 1)."""
    sample = _sampled(docs, labels, metadata or [], rows).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(SHARDS)))
    model, seen = Model.blank(), Model.blank()
    model.factors = np.random.default_rng(seed).normal(0, 0.05, (FEATURES, RANK))
    for turn in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast((model, seen))
        # As many rows as shards, of a fixed size.
        parts = sample.groupBy("shard").applyInArrow(_learner(shared, turn), "n long, parameters binary").collect()
        if not parts:
            return Model.blank()
        total = sum(r.n for r in parts)
        flat = sum(np.frombuffer(r.parameters, "<f4").astype(np.float64) * (r.n / total) for r in sorted(parts, key=lambda r: (r.n, bytes(r.parameters))))
        cuts = np.cumsum([FEATURES + 1, FEATURES * RANK, FEATURES + 1])
        w, v, sw, sv = np.split(flat, cuts)
        model, seen = Model(w, v.reshape(FEATURES, RANK)), Model(sw, sv.reshape(FEATURES, RANK))
        shared.unpersist()
    return Model(model.weights.astype(np.float32), model.factors.astype(np.float32))


def score(docs: DataFrame, model: Model, keep: list[str], metadata: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every row with score (0 to 1) and predicted (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    metadata = metadata or []
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, own = Tokens(), shared.value
        for batch in batches:
            margins = [np.zeros(0)]
            texts, more = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 64):
                found = [features(t, _values(m, metadata), tokens) for t, m in zip(texts[at : at + 64], more[at : at + 64])]
                sizes = np.array([len(p) for p, _ in found])
                places = np.concatenate([p for p, _ in found])
                margins.append(own.margins(places, np.concatenate([v for _, v in found]), np.cumsum(sizes) - sizes)[0])
            scores = probability(np.concatenate(margins).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))], names=names
            )

    texts = docs.select(
        F.col("text").alias("t"), (F.struct(*metadata) if metadata else F.lit(None).cast("string")).alias("m"), *keep
    )
    return texts.mapInArrow(run, schema)
