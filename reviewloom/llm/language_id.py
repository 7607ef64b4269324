"""Language identification by known words first, then ever shorter character n-grams.

A model is fitted on a bounded sample of labelled rows: per language about ``sample_documents`` whole texts,
taken by a hash of the id. It holds the log frequency of the most common words and n-grams of words per language;
words that the whole sample has once are left to their n-grams. Sizes are parameters, and bound what goes to the
tasks: sorted 64-bit hashes of the entries with their frequencies. A word of the model adds its log frequencies; an unseen word adds the mean of those n-grams of it
that are known, of the longest length at which any is. The language with the highest sum wins, ties going to
the alphabetically first; the score is its posterior with equal priors.

A text that is null or has no letter is ``und`` with score 0. Without a single labelled row every text is.
Only the text is read for a prediction. Repeated rows are judged each for itself; other columns pass through
or are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.columns import gives_back, slices, utf8
from reviewloom.llm.hashes import prefix_hashes, span_hashes
from reviewloom.plans.joins import lookup_join
from reviewloom.plans.storage import materialise

SAMPLE_DOCUMENTS = 3_000
# The most common entries of each language are kept, whatever the other languages have.
WORD_ENTRIES, GRAM_ENTRIES = 160_000, 80_000
# Words and n-grams of all languages together; with many languages each gets an equal part, at least one of both.
ALL_ENTRIES = 2_000_000
GRAM_SIZES = (4, 3, 2, 1)
CACHED_WORDS, CACHED_BYTES = 200_000, 1 << 26
TEXTS_AT_ONCE = 500
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    """The n-grams of a word between blanks; single characters without the blanks."""
    padded = f" {word} " if size > 1 else word
    return [padded[k : k + size] for k in range(len(padded) - size + 1)]


@dataclass
class LogTable:
    """Rows of log frequencies; a language without the entry has the default of the entry's kind."""

    defaults: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def _row(self, at: int) -> np.ndarray:
        row = self.defaults[self.kinds[at]].copy()
        own = slice(self.starts[at], self.starts[at + 1])
        row[self.places[own]] = self.values[own]
        return row

    def __getitem__(self, at: int | list[int]) -> np.ndarray:
        return np.stack([self._row(k) for k in at]) if isinstance(at, list) else self._row(at)


@dataclass
class Model:
    """Log frequencies by language; entry 0 of ``table`` is no evidence."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | LogTable = field(default_factory=lambda: np.zeros((1, 0), np.float32))

    def vector(self, word: str) -> np.ndarray:
        at = self.words.get(word)
        if at is not None:
            return self.table[at]
        for size in GRAM_SIZES:
            known = [k for g in grams_of(word, size) if (k := self.grams.get(g)) is not None]
            if known:
                return self.table[known].mean(axis=0)
        return self.table[0]


class Lookup:
    """A model as sorted 64-bit hashes and flat arrays, so that the vectors of many words are found at once."""

    def __init__(self, model: Model):
        self.languages = model.languages
        table = model.table
        if isinstance(table, np.ndarray):
            rows, width = table.shape
            table = LogTable(
                np.zeros((1, width)), np.zeros(rows, np.int64), np.arange(rows + 1) * width,
                np.tile(np.arange(width, dtype=np.int32), rows), table.ravel(),
            )
        self.defaults = table.defaults.astype(np.float64)
        self.kinds, self.starts, self.places = table.kinds.astype(np.int8), table.starts, table.places
        of_value = np.repeat(table.kinds, np.diff(table.starts))
        self.gains = (table.values - self.defaults[of_value, table.places]).astype(np.float32)
        self.keys = {name: _sorted_hashes(getattr(model, name)) for name in ("words", "grams")}

    def _entries(self, name: str, found: np.ndarray) -> np.ndarray:
        """The entry of every hash, -1 if there is none."""
        keys, entries = self.keys[name]
        if not len(keys):
            return np.full(len(found), -1)
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        return np.where(keys[at] == found, entries[at], -1)

    def _sums(self, owners: np.ndarray, entries: np.ndarray, n: int) -> np.ndarray:
        """The sum of the rows ``entries`` for each of ``n`` owners."""
        width, kinds = len(self.languages), len(self.defaults)
        out = np.bincount(owners * kinds + self.kinds[entries], minlength=n * kinds).reshape(n, kinds) @ self.defaults
        sizes = self.starts[entries + 1] - self.starts[entries]
        values = np.arange(sizes.sum()) + np.repeat(self.starts[entries] - (np.cumsum(sizes) - sizes), sizes)
        cells = np.repeat(owners, sizes) * width + self.places[values]
        return out + np.bincount(cells, self.gains[values], n * width).reshape(n, width)

    def vectors(self, words: list[str]) -> np.ndarray:
        """As ``Model.vector`` for every word."""
        n = len(words)
        out = self._sums(np.arange(n), np.zeros(n, np.int64), n)
        text = np.frombuffer("".join(f" {w} " for w in words).encode("utf-8", "replace"), np.uint8)
        # Where characters begin, whose they are, and where each word's begin among them.
        begins = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
        sizes = np.array([len(w) + 2 for w in words])
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(n), sizes)
        sums = prefix_hashes(text)
        entries = self._entries("words", span_hashes(sums, begins[ends - sizes + 1], begins[ends - 1]))
        known = np.flatnonzero(entries >= 0)
        out[known] = self._sums(np.arange(len(known)), entries[known], len(known))
        open_ = entries < 0
        for size in GRAM_SIZES:
            first = np.arange(len(owner) - size + 1)
            inside = (owner[first] == owner[first + size - 1]) & open_[owner[first]]
            if size == 1:
                inside &= (first != (ends - sizes)[owner[first]]) & (first != ends[owner[first]] - 1)
            first = first[inside]
            entries = self._entries("grams", span_hashes(sums, begins[first], begins[first + size]))
            hit = entries >= 0
            of = owner[first[hit]]
            counts = np.bincount(of, minlength=n)
            met = np.flatnonzero(counts)
            if len(met):
                place = np.zeros(n, np.int64)
                place[met] = np.arange(len(met))
                out[met] = self._sums(place[of], entries[hit], len(met)) / counts[met, None]
                open_[met] = False
        return out


def _sorted_hashes(entries: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    if not entries:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = []
    names = list(entries)
    for k in range(0, len(names), 50_000):
        data, ends = utf8(pa.array(names[k : k + 50_000]))
        found.append(span_hashes(prefix_hashes(data), ends[:-1], ends[1:]))
    keys = np.concatenate(found)
    order = np.argsort(keys, kind="stable")
    return keys[order], np.fromiter(entries.values(), np.int64, len(entries))[order]


class _Judge:
    """The vectors of the words met so far, forgotten when there are too many."""

    def __init__(self, lookup: Lookup):
        self.lookup = lookup
        width = max(1, len(lookup.languages))
        self.most = max(4, min(CACHED_WORDS, CACHED_BYTES // (8 * width)))
        self.places: dict[str, int] = {}
        self.rows = np.zeros((self.most, width))

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.places]
        if len(self.places) + len(new) > self.most:
            self.places.clear()
            new = list(dict.fromkeys(words))
        if new:
            at = len(self.places)
            for k in range(0, len(new), 5_000):
                part = new[k : k + 5_000]
                self.rows[at + k : at + k + len(part)] = self.lookup.vectors(part)
            self.places.update(zip(new, range(at, at + len(new))))

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text."""
        languages = self.lookup.languages
        totals, told = np.zeros((len(texts), self.rows.shape[1])), np.zeros(len(texts), bool)
        room = self.most // 4
        owners, sizes, words = [], [], []

        def add_up() -> None:
            if words:
                self._learn(words)
                found = self.rows[list(map(self.places.__getitem__, words))]
                np.add.at(totals, owners, np.add.reduceat(found, np.cumsum(sizes) - sizes, axis=0))
            for kept in (owners, sizes, words):
                kept.clear()

        for n, text in enumerate(texts if languages else ()):
            own = words_of(text or "")
            told[n] = any(any(map(str.isalpha, w)) for w in own)
            for k in range(0, len(own) if told[n] else 0, room):
                part = own[k : k + room]
                if len(words) + len(part) > room:
                    add_up()
                owners.append(n)
                sizes.append(len(part))
                words.extend(part)
        add_up()
        best = totals.argmax(axis=1)
        scores = 1.0 / np.exp(totals - totals[np.arange(len(texts)), best][:, None]).sum(axis=1)
        return [languages[k] if t else UNKNOWN for k, t in zip(best, told)], np.where(told, scores, 0.0)


def training_row(doc_id: Column) -> Column:
    """True for rows the model may learn from: crc32 of the id as text, mod 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, by a hash of the id; all of a smaller one."""
    rows = labelled.select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").count().select("lang", (F.lit(float(per_language)) / F.col("count")).alias("_share"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    shares = counts.where("lang IS NOT NULL")
    return lookup_join(rows, shares, "lang").where(place < F.col("_share")).select("text", "lang")


def _counts(rows: DataFrame) -> DataFrame:
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, TEXTS_AT_ONCE)):
            by_language: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_language.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by_language.items():
                grams: Counter = Counter()
                for word, n in words.items():
                    for size in GRAM_SIZES:
                        for gram in grams_of(word, size):
                            grams[gram] += n
                for is_word, found in ((True, words), (False, grams)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(found), pa.string()),
                            pa.array([is_word] * len(found), pa.bool_()),
                            pa.array(list(found), pa.string()),
                            pa.array(list(found.values()), pa.int64()),
                        ],
                        names=["lang", "is_word", "entry", "n"],
                    )

    found = rows.mapInArrow(run, "lang string, is_word boolean, entry string, n long")
    return found.groupBy("is_word", "entry", "lang").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, per_language: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from rows (doc_id, text, lang); rows without text or language are left out.

    Every language is learned, with at most its 160,000 most common words and 80,000 most common n-grams.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = _counts(sample(rows, per_language))
    entries = materialise(
        counts.groupBy("is_word", "entry")
        .agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by_language"))
        .where("total > 1 OR NOT is_word")
    )
    found = _most_common(entries).select("is_word", "entry", "by_language").toArrow()
    if not len(found):
        return Model([])
    by_language = found["by_language"].combine_chunks()
    starts = np.append(0, np.cumsum(by_language.value_lengths().to_numpy())).astype(np.int64)
    names, n = by_language.flatten().field("lang").to_pylist(), by_language.flatten().field("n").to_numpy()
    languages = sorted(set(names))
    place = {lang: k for k, lang in enumerate(languages)}
    places = np.array([place[x] for x in names], np.int32)
    model = Model(languages)
    # Kind 0 is words, others are n-grams by length; the last is entry 0.
    kinds = [1 + max(GRAM_SIZES)]
    for at, (is_word, entry) in enumerate(zip(found["is_word"].to_pylist(), found["entry"].to_pylist()), 1):
        (model.words if is_word else model.grams)[entry] = at
        kinds.append(0 if is_word else len(entry))
    kind_of = np.array(kinds)
    of_value = np.repeat(kind_of[1:], np.diff(starts))
    sums = np.repeat(0.5 * np.bincount(kind_of, minlength=kinds[0] + 1)[:, None], len(languages), axis=1)
    np.add.at(sums, (of_value, places), n)
    defaults = np.log(0.5 / np.maximum(sums, 0.5))
    defaults[kinds[0]] = 0.0
    values = np.log((n + 0.5) / sums[of_value, places])
    model.table = LogTable(
        defaults.astype(np.float32), kind_of, np.append(0, starts), places, values.astype(np.float32)
    )
    return model


def _most_common(entries: DataFrame) -> DataFrame:
    """The ``entries`` that are among the most common of one of their languages."""
    flat = entries.select("is_word", "entry", F.inline("by_language"))
    sizes = flat.groupBy("is_word", "lang").count()
    languages = max(1, flat.select("lang").distinct().count())
    words, grams = (max(1, min(n, ALL_ENTRIES // (2 * languages))) for n in (WORD_ENTRIES, GRAM_ENTRIES))
    bound = F.when(F.col("is_word"), words).otherwise(grams)
    if sizes.where(F.col("count") > bound).isEmpty():
        return entries
    # Few rows: those of the sample's words, by language.
    ranked = Window.partitionBy("is_word", "lang").orderBy(F.desc("n"), "entry")
    kept = flat.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= bound)
    return entries.join(kept.select("is_word", "entry").distinct(), ["is_word", "entry"], "left_semi")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score instead of its text; only ``text`` is looked at.

    ``docs`` must not have columns of these two names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Lookup(model))
    others = [c for c in docs.columns if c != "text"]

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(shared.value)
        for batch in (part for whole in batches for part in slices(whole, TEXTS_AT_ONCE)):
            names, scores = judge.judge(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*others, "lang_pred", "score"],
            )

    schema = docs.select(*others).schema.add("lang_pred", "string").add("score", "double")
    return docs.select("text", *others).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(Lookup(model))
    at = docs.columns.index("text")

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(shared.value)
        for batch in (part for whole in batches for part in slices(whole, TEXTS_AT_ONCE)):
            kept = [name != UNKNOWN for name in judge.judge(batch.column(at).to_pylist())[0]]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
