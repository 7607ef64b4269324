"""Multinomial naive Bayes as grouped counts.

Training counts (token, class) pairs with map-side partial sums, so frequent tokens and big classes
do not pile up. Scoring adds up log-probabilities per document; texts are always used whole.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.labels import argmax
from reviewloom.functions.tokens import words
from reviewloom.operators.classification import MetricRegistry, auc_hard, confusion
from reviewloom.plans.joins import common_and_rare, frequency_join, skew_join
from reviewloom.plans.storage import materialise


@dataclass(frozen=True)
class NaiveBayes:
    """tokens: one stored row (token, n, seen) per token, seen listing (idx, cnt) per class.

    classes: one (idx, n_docs, total) per class, by index. A score row has one number per class,
    so the class list is as small as one row of scores.
    """

    tokens: DataFrame
    classes: list[tuple[int, int, int]]
    vocabulary: int
    alpha: float = 1.0
    uniform_prior: bool = False
    gains: DataFrame | None = None

    @property
    def n_docs(self) -> int:
        return sum(c[1] for c in self.classes)

    def with_alpha(self, alpha: float) -> NaiveBayes:
        return replace(self, alpha=alpha, gains=None)

    def configured(self, trial: Mapping) -> NaiveBayes:
        """This model with a trial's ``alpha``, ``vocab_size`` (0 for all tokens) and ``uniform_prior``."""
        model = _limited(self, trial["vocab_size"]) if trial["vocab_size"] else self
        return replace(model, alpha=trial["alpha"], uniform_prior=bool(trial["uniform_prior"]), gains=None)

    def prepared(self) -> NaiveBayes:
        """This model with the gains of its tokens stored, for several predictions.

        A gain is what an occurrence of the token adds to a class's score over the default; there is one a class.
        """
        if self.gains is not None:
            return self
        gains = F.transform(
            F.array(*[F.lit(idx) for idx, _, _ in self.classes]),
            lambda idx: F.log1p(
                F.coalesce(F.get(F.filter("seen", lambda e: e["idx"] == idx), F.lit(0))["cnt"], F.lit(0)) / F.lit(self.alpha)
            ),
        )
        return replace(self, gains=materialise(self.tokens.select("token", "n", gains.alias("gains"))))

    def class_table(self) -> DataFrame:
        """(idx, prior, default_logp): class prior, and the score of a token unseen in the class."""
        spark = self.tokens.sparkSession
        return spark.createDataFrame(self.classes, "idx int, n_docs bigint, total bigint").select(
            "idx",
            "total",
            (F.lit(0.0) if self.uniform_prior else F.log(F.col("n_docs") / F.lit(self.n_docs))).alias("prior"),
            F.log(self.alpha / (F.col("total") + F.lit(self.alpha * self.vocabulary))).alias(
                "default_logp"
            ),
        )

    def log_probabilities(self) -> DataFrame:
        """(idx, token, logp) for the pairs seen in training."""
        smoothed = (F.col("cnt") + F.lit(self.alpha)) / (
            F.col("total") + F.lit(self.alpha * self.vocabulary)
        )
        pairs = self.tokens.select("token", F.explode("seen").alias("s")).select("token", "s.*")
        return pairs.join(F.broadcast(self.class_table()), "idx").select(
            "idx", "token", F.log(smoothed).alias("logp")
        )


def train(df: DataFrame, text: str, label: str, alpha: float = 1.0) -> NaiveBayes:
    """Counts tokens per class; ``label`` is a class index."""
    pairs = df.select(
        F.col(label).cast("int").alias("idx"),
        F.posexplode_outer(words(F.col(text))).alias("pos", "token"),
    )
    # A document is counted at its first token; one without tokens leaves a row without a token.
    counts = pairs.groupBy("token", "idx").agg(
        F.count("token").alias("cnt"),
        F.count(F.when(F.coalesce("pos", F.lit(0)) == 0, 1)).alias("docs"),
    )
    counts = materialise(counts)
    totals = counts.groupBy("idx").agg(F.sum("docs").alias("docs"), F.sum("cnt").alias("cnt")).collect()
    classes = sorted((row["idx"], row["docs"], row["cnt"]) for row in totals)
    # A plain sum for each class keeps few numbers a token; lists of classes would be collected token by token.
    own = [F.sum(F.when(F.col("idx") == idx, F.col("cnt"))).alias(f"__cnt_{place}") for place, (idx, _, _) in enumerate(classes)]
    summed = counts.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("cnt").alias("n"), *own)
    entries = [
        F.when(F.col(f"__cnt_{place}").isNotNull(), F.struct(F.lit(idx).alias("idx"), F.col(f"__cnt_{place}").alias("cnt")))
        for place, (idx, _, _) in enumerate(classes)
    ]
    seen = F.filter(F.array(*entries).cast("array<struct<idx:int,cnt:bigint>>"), lambda e: e.isNotNull())
    tokens = materialise(summed.select("token", "n", seen.alias("seen")))
    return NaiveBayes(tokens, classes, tokens.count(), alpha)


def _matched(docs: DataFrame, carried: Sequence[str], text: str, stored: DataFrame) -> DataFrame:
    """Every token of every text with its training counts per class, null for unknown tokens."""
    tokens = docs.select(*carried, F.explode_outer(words(F.col(text))).alias("token"))
    return frequency_join(tokens, stored, "token", F.col("n"))


def _class_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _scores(model: NaiveBayes, gains: Column, known: Column, alpha: float, vocabulary: int,
            totals: Sequence[int], uniform_prior: bool = False) -> Column:
    """Scores by class: prior + known tokens x default + gains over the default."""
    n = model.n_docs
    priors = [0.0 if uniform_prior else math.log(docs / n) for _, docs, _ in model.classes]
    defaults = [math.log(alpha / (total + alpha * vocabulary)) for total in totals]
    spots = F.array(*[F.lit(idx) for idx, _, _ in model.classes])
    return F.transform(
        F.arrays_zip(spots.alias("idx"), _class_literal(priors).alias("prior"),
                     _class_literal(defaults).alias("default_logp")),
        lambda c: c["prior"] + known * c["default_logp"] + F.coalesce(
            F.get(F.filter(gains, lambda g: g["idx"] == c["idx"]), F.lit(0))["gain"], F.lit(0.0)
        ),
    )


def _summed_gains(docs: DataFrame, columns: Sequence[str], text: str, stored: DataFrame, classes: int) -> DataFrame:
    """(columns, __known, __gain_i): per document its known tokens, and the sum of their gains for each class.

    Common tokens are summed where they are. Of a document only its distinct other tokens, with their number, are
    stored and go through the exchange to the rare ones.
    """
    places = [f"__gain_{place}" for place in range(classes)]
    sums = [F.sum(F.col("gains")[place]).alias(name) for place, name in enumerate(places)]
    tokens = docs.select(*columns, F.explode_outer(words(F.col(text))).alias("token"))
    common, rare = common_and_rare(stored, F.col("n"))
    if rare is None:
        met = tokens.join(F.broadcast(common), "token", "left")
        return met.groupBy(*columns).agg(F.count("gains").alias("__known"), *sums)
    tried = tokens.join(F.broadcast(common), "token", "left")
    left = F.when(F.col("gains").isNull(), F.col("token")).alias("__left")
    parts = materialise(
        tried.groupBy(*columns, left).agg(F.count(F.lit(1)).alias("__times"), F.count("gains").alias("__known"), *sums)
    )
    rest = parts.filter(F.col("__left").isNotNull()).select(*columns, F.col("__left").alias("token"), "__times")
    found = skew_join(rest, rare, "token").select(
        *columns, F.col("__times").alias("__known"),
        *[(F.col("gains")[place] * F.col("__times")).alias(name) for place, name in enumerate(places)],
    )
    both = parts.select(*columns, "__known", *places).unionByName(found)
    return both.groupBy(*columns).agg(F.sum("__known").alias("__known"), *[F.sum(p).alias(p) for p in places])


def predict(
    docs: DataFrame, key: str, text: str, model: NaiveBayes, carried: Sequence[str] = ()
) -> DataFrame:
    """(key, carried columns, scores, pred): class scores by index, and the first best index.

    Documents without a known token keep the prior. A document's tokens start in one task, so its
    sums, one a class, are nearly complete before the one exchange.
    """
    columns = [key, *carried]
    per_doc = _summed_gains(docs, columns, text, model.prepared().gains, len(model.classes))
    n = model.n_docs
    scores = [
        F.lit(0.0 if model.uniform_prior else math.log(docs_of / n))
        + F.col("__known") * F.lit(math.log(model.alpha / (total + model.alpha * model.vocabulary)))
        + F.coalesce(F.col(f"__gain_{place}"), F.lit(0.0))
        for place, (_, docs_of, total) in enumerate(model.classes)
    ]
    indices = F.array(*[F.lit(c[0]) for c in model.classes])
    return per_doc.select(*columns, F.array(*scores).alias("scores")).withColumn(
        "pred", F.element_at(indices, argmax(F.col("scores")) + 1)
    )


def _ranked_tokens(model: NaiveBayes, largest: int | None) -> DataFrame:
    """Per token its class counts and its frequency rank, null beyond the largest limit in use."""
    if largest is None:
        return model.tokens.withColumn("rank", F.lit(None).cast("int"))
    order = [F.col("n").desc(), F.col("token")]
    top = (
        model.tokens.select("token", "n")
        .orderBy(*order)
        .limit(largest)
        .select("token", F.row_number().over(Window.orderBy(*order)).alias("rank"))
    )
    return model.tokens.join(top, "token", "left")


def _limited(model: NaiveBayes, size: int) -> NaiveBayes:
    """The model of its ``size`` most frequent tokens; documents per class stay as they are."""
    tokens = materialise(_ranked_tokens(model, size).filter("rank IS NOT NULL").drop("rank"))
    entries = tokens.select(F.explode("seen").alias("e")).select("e.*")
    totals = {row["idx"]: row["n"] for row in entries.groupBy("idx").agg(F.sum("cnt").alias("n")).collect()}
    classes = [(idx, docs, totals.get(idx, 0)) for idx, docs, _ in model.classes]
    return replace(model, tokens=tokens, classes=classes, vocabulary=min(size, model.vocabulary), gains=None)


def trial_counts(
    docs: DataFrame, key: str, text: str, label: str, model: NaiveBayes, trials: Sequence[dict]
) -> DataFrame:
    """(trial_id, label, pred, n) of all trials from one pass over the texts, stored.

    A trial has ``alpha``, ``vocab_size`` (0 for all tokens) and ``uniform_prior``. Trials share the
    token join: each distinct setting only adds sums to the same grouped aggregate.
    """
    sizes = sorted({t["vocab_size"] for t in trials})
    settings = sorted({(t["vocab_size"], t["alpha"]) for t in trials})
    limited = [s for s in sizes if s]
    ranked = materialise(_ranked_tokens(model, max(limited) if limited else None))

    def inside(size: int) -> Column:
        return F.lit(True) if size == 0 else F.coalesce(F.col("rank") <= size, F.lit(False))

    flat = ranked.select("rank", F.explode("seen").alias("entry")).select("rank", "entry.*")
    class_totals = {
        row["idx"]: row
        for row in flat.groupBy("idx")
        .agg(*[F.sum(F.when(inside(s), F.col("cnt")).otherwise(0)).alias(f"v{s}") for s in sizes])
        .collect()
    }
    columns = [key, label]
    seen = _matched(docs.select(*columns, text), columns, text, ranked)
    spread = seen.select(
        *columns, "rank", F.col("seen").isNotNull().alias("hit"),
        F.posexplode_outer("seen").alias("place", "entry"),
    )
    first = F.col("hit") & (F.col("place") == 0)
    sums = [
        F.count(F.when(first & inside(s), 1)).alias(f"known_{s}") for s in sizes
    ] + [
        F.sum(F.when(inside(s) & F.col("hit"), F.log1p(F.col("entry.cnt") / F.lit(a))).otherwise(0.0)).alias(f"gain_{i}")
        for i, (s, a) in enumerate(settings)
    ]
    per_class = spread.groupBy(*columns, F.col("entry.idx").alias("idx")).agg(*sums)
    per_doc = per_class.groupBy(*columns).agg(
        *[F.sum(f"known_{s}").alias(f"known_{s}") for s in sizes],
        *[
            F.collect_list(F.struct(F.col("idx"), F.col(f"gain_{i}").alias("gain"))).alias(f"gains_{i}")
            for i in range(len(settings))
        ],
    )
    indices = F.array(*[F.lit(c[0]) for c in model.classes])
    outcomes = []
    for trial in trials:
        size, alpha = trial["vocab_size"], trial["alpha"]
        totals = [
            (class_totals[c[0]][f"v{size}"] if c[0] in class_totals else 0) for c in model.classes
        ]
        words_used = model.vocabulary if size == 0 else min(size, model.vocabulary)
        scores = _scores(
            model, F.col(f"gains_{settings.index((size, alpha))}"), F.col(f"known_{size}"),
            alpha, words_used, totals, bool(trial["uniform_prior"]),
        )
        outcomes.append(
            F.struct(
                F.lit(trial["trial_id"]).alias("trial_id"),
                F.element_at(indices, argmax(scores) + 1).alias("pred"),
            )
        )
    judged = per_doc.select(label, F.explode(F.array(*outcomes)).alias("o")).select(label, "o.*")
    return materialise(confusion(judged, label, "pred", by=["trial_id"]))


def trial_metrics(counts: DataFrame) -> DataFrame:
    """(trial_id, metric columns) from the counts of each trial."""
    area = auc_hard(counts, by=["trial_id"]).select("trial_id", F.col("auc").alias("auc_weighted"))
    return MetricRegistry().compute(counts, by=["trial_id"]).join(area, "trial_id")


def score_trials(
    docs: DataFrame, key: str, text: str, label: str, model: NaiveBayes, trials: Sequence[dict]
) -> DataFrame:
    """(trial_id, metric columns) of all trials from one pass over the texts."""
    return trial_metrics(trial_counts(docs, key, text, label, model, trials))
