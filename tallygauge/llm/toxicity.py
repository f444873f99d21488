"""A toxicity classifier that is regularised by counterfactuals.

A logistic model over which words and beginnings of words a text has. A labelled text that names a
group of people is copied with the name swapped for others, and the loss adds the squared change of
the score between the text and its copies, so that a neutral mention of a group does not count as
toxic. A penalty on the sum of the weights keeps few features, so that long clean texts do
not add up to a high score.

The model is fitted from a bounded sample: ``MOST_ROWS`` labelled rows, taken by a hash of ``doc_id``
and alike at any size. Spark counts in how many toxic and other sampled texts each feature is; the
``MOST_FEATURES`` whose presence goes most with the label enter the fit, which runs on the driver over
those features of those rows. What goes to the tasks is one weight per feature. Every text is
scored whole.

Defined results: null, empty and wordless texts get the score of the intercept alone; labels
that are null or whose document is missing are passed over; of several labels of a document the
largest counts; without labelled rows every score is 0; repeated rows get equal scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.language_id import crc_of
from tallygauge.llm.storage import documents_only, saved

THRESHOLD = 0.7
#: The bounds of the sample and of the model.
MOST_ROWS = 20_000
MOST_FEATURES = 5_000
#: A feature must be in so many sampled texts.
LEAST_TEXTS = 4
#: Letters of the beginnings of words.
BEGINNINGS = (4, 5, 6)
#: Strengths of the penalties on weights and on counterfactual changes, and rounds of fitting.
SPARSITY, FAIRNESS, ROUNDS = 1e-4, 1.0, 600
#: How far a feature's share of toxic texts must be from what chance gives it, in shares of the sample.
LEAST_GAIN = 5e-4
#: Names of groups by what they name; a name is swapped for the others in its row.
IDENTITIES = (
    ("women", "men", "girls", "boys", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("old", "young", "disabled", "blind", "deaf"),
)
WORD = re.compile(r"[^\W\d_]+")


OTHERS = {name: [o for o in row if o != name] for row in IDENTITIES for name in row}


def features(text: str | None) -> set[str]:
    """The words of a text, and with ``^`` the beginnings of its longer words."""
    return of_words(set(WORD.findall((text or "").lower())))


def of_words(words: set[str]) -> set[str]:
    found = set(words)
    for n in BEGINNINGS:
        found |= {f"^{w[:n]}" for w in words if len(w) > n}
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    intercept: float

    def score(self, text: str | None) -> float:
        words = set(WORD.findall((text or "").lower()))
        found = self.weights.keys() & words
        for n in BEGINNINGS:
            found |= self.weights.keys() & {f"^{w[:n]}" for w in words if len(w) > n}
        total = self.intercept + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def sampled(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """``doc_id``, ``toxic`` and ``text`` of the labelled texts to learn from."""
    known = labels.where(F.col("toxic").isNotNull() & training).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_ROWS)
    # The sample is at most MOST_ROWS ids, so they go to the texts and the texts stay where they are.
    texts = documents_only(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    return saved(texts, "labelled")


def chosen_features(rows: DataFrame, toxic_share: float, total: int) -> list[str]:
    """The features that go most with the label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, toxic = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = features(text.as_py())
                every.update(own)
                if label:
                    toxic.update(own)
            n, n_toxic = list(every.values()), [toxic[f] for f in every]
            columns = [pa.array(list(every), "string"), pa.array(n, "int64"), pa.array(n_toxic, "int64")]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "n", "n_toxic"])

    parts = rows.select("toxic", "text").mapInArrow(count, "feature string, n bigint, n_toxic bigint")
    sums = parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
    gain = F.abs(F.col("n_toxic") - F.col("n") * toxic_share) / total
    top = sums.where((F.col("n") >= LEAST_TEXTS) & (gain > LEAST_GAIN)).orderBy(F.desc(gain), "feature").limit(MOST_FEATURES)
    return [r["feature"] for r in top.select("feature").collect()]


def swapped(words: set[str]) -> Iterator[set[str]]:
    """The words with each name of a group swapped for each of the others in its row."""
    for name in sorted(words & OTHERS.keys()):
        for other in OTHERS[name]:
            yield (words - {name}) | {other}


def entries(rows: DataFrame, chosen: list[str]) -> pa.Table:
    """``toxic``, ``copy`` and ``own``: the chosen features of every text (copy 0) and its swapped copies."""
    place = {f: i for i, f in enumerate(chosen)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(WORD.findall((text or "").lower()))
                for copy, own in enumerate((words, *swapped(words))):
                    found.append((doc_id, label, copy, sorted(place[f] for f in of_words(own) & place.keys())))
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "copy", "own"])

    types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
    kind = "doc_id bigint, toxic int, copy int, own array<int>"
    return rows.select("doc_id", "toxic", "text").mapInArrow(find, kind).orderBy("doc_id", "copy").toArrow()


@dataclass(frozen=True)
class Sparse:
    """A matrix of few entries."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.shape[1])

    def norm(self) -> float:
        """The largest squared singular value, from above."""
        w = np.ones(self.shape[1])
        for _ in range(30):
            w = self.back(self.times(w))
            size = np.linalg.norm(w)
            if not size:
                return 0.0
            w /= size
        return 1.1 * size


def fit(docs: DataFrame, labels: DataFrame, training: Column) -> Model:
    """The model of the labelled rows for which ``training``, a condition on ``doc_id``, holds."""
    rows = sampled(docs, labels, training)
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not total or not toxic:
        return Model({}, -500.0)
    chosen = chosen_features(rows, toxic / total, total)
    table = entries(rows, chosen)
    copy = table["copy"].to_numpy()
    lists = table["own"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    row, column = np.repeat(np.arange(len(copy)), sizes), lists.flatten().to_numpy().astype(np.int64)
    original = np.maximum.accumulate(np.where(copy == 0, np.arange(len(copy)), 0))
    number = np.cumsum(copy == 0) - 1
    # The constant is the last column.
    first = copy[row] == 0
    n, width = int((copy == 0).sum()), len(chosen) + 1
    x_row = np.concatenate((number[row[first]], np.arange(n)))
    x_column = np.concatenate((column[first], np.full(n, width - 1)))
    x = Sparse(x_row, x_column, np.ones(len(x_row)), (n, width))
    copies = np.flatnonzero(copy)
    starts = np.cumsum(sizes) - sizes
    d_row, d_column, d_value = [row[:0]], [column[:0]], [np.empty(0)]
    for i, at in enumerate(copies):
        for source, sign in ((at, 1.0), (original[at], -1.0)):
            own = column[starts[source] : starts[source] + sizes[source]]
            d_row.append(np.full(len(own), i))
            d_column.append(own)
            d_value.append(np.full(len(own), sign))
    d = Sparse(np.concatenate(d_row), np.concatenate(d_column), np.concatenate(d_value), (max(1, len(copies)), width))
    w = fitted(x, table["toxic"].to_numpy()[copy == 0], d)
    return Model({f: float(v) for f, v in zip(chosen, w[:-1], strict=True) if v}, float(w[-1]))


def fitted(x: Sparse, y: np.ndarray, d: Sparse) -> np.ndarray:
    """Weights by accelerated proximal steps; the constant, the last weight, is not penalised."""
    n, m = x.shape[0], d.shape[0]
    step = 1 / (0.25 * x.norm() / n + FAIRNESS * d.norm() / m)
    w = ahead = np.zeros(x.shape[1])
    pace = 1.0
    for _ in range(ROUNDS):
        miss = 1 / (1 + np.exp(-np.clip(x.times(ahead), -500, 500))) - y
        new = ahead - step * (x.back(miss) / n + FAIRNESS * d.back(d.times(ahead)) / m)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * SPARSITY, 0)
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / after * (new - w)
        w, pace = new, after
    return w


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(1)], "float64")
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    return documents_only(docs).mapInArrow(judge, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``; a third of the documents is held out."""
    held_out = F.coalesce(crc_of("doc_id") % 3 == 1, F.lit(False))
    model = fit(docs, labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"), ~held_out)
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted)
