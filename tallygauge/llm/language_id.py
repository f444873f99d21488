"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams (one to three letters, words
padded with a boundary), most frequent first. A text is compared by the out-of-place distance: for
each of its own most frequent n-grams, how far its rank is from its rank in the profile, or the
length of a profile where it is not in there. The nearest profile wins.

Counts are taken over all training rows: each task counts n-grams per language in pieces of bounded
size, Spark adds them up, and the top of each language is a window with a limit that Spark applies
before it shuffles. Only profiles come to the driver: ``PROFILE`` rows per language.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every
text where nothing can be learned; ``with_language`` drops the former and keeps the latter, whose
missing ``lang`` stays null. Of languages at equal distance the first by name wins. Rows are
judged one by one, so repeated rows get equal results; other columns are passed over.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: N-grams of a profile, of a language and of a text.
PROFILE = 400
#: Letters that a task counts at a time.
LETTERS_AT_ONCE = 4_000_000
BITS = 21
ABSENT = (1 << BITS) - 1


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters(text: str) -> np.ndarray:
    """The lower-case letters of a text; every run between words is one 0, as are both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letter = letter_table()[codes]
    after = np.empty_like(letter)
    after[:1] = False
    after[1:] = letter[:-1]
    return np.concatenate(([0], np.where(letter, codes, 0)[letter | after], [0]))


def grams(c: np.ndarray) -> np.ndarray:
    """The one-, two- and three-letter n-grams of ``letters``, as numbers."""
    both = (c[:-1] | c[1:]) != 0
    one = c[c != 0] | (ABSENT << BITS) | (ABSENT << 2 * BITS)
    two = ((c[:-1] << BITS) | c[1:] | (ABSENT << 2 * BITS))[both]
    three = ((c[:-2] << 2 * BITS) | (c[1:-1] << BITS) | c[2:])[c[1:-1] != 0]
    return np.concatenate((one, two, three))


def ranked(codes: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by number."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:most]]


@dataclass(frozen=True)
class Profiles:
    names: tuple[str, ...]
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # a row per n-gram, a column per language; PROFILE where it is absent

    @staticmethod
    def of(tops: dict[str, list[int]]) -> Profiles:
        names = tuple(sorted(tops))
        values = np.array(sorted({g for top in tops.values() for g in top}), dtype=np.int64)
        ranks = np.full((len(values), len(names)), PROFILE, dtype=np.int64)
        for column, name in enumerate(names):
            ranks[np.searchsorted(values, tops[name]), column] = np.arange(len(tops[name]))
        return Profiles(names, values, ranks)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judged(text)[:2]

    def judged(self, text: str | None) -> tuple[str, float, bool]:
        """The language of a text, its score, and whether the text has a letter."""
        c = letters(text or "")
        if len(c) < 3:
            return UNDETERMINED, 0.0, False
        if not self.names:
            return UNDETERMINED, 0.0, True
        own = ranked(grams(c))
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        away = np.abs(self.ranks[at[known]] - np.arange(len(own))[known, None])
        away[self.ranks[at[known]] == PROFILE] = PROFILE
        distance = away.sum(axis=0) + PROFILE * (len(own) - known.sum())
        best = int(distance.argmin())
        if len(self.names) == 1:
            return self.names[best], 1.0, True
        second = float(np.partition(distance, 1)[1])
        total = second + float(distance[best])
        return self.names[best], second / total if total else 0.5, True


def counted(rows: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all ``rows`` (``lang``, ``text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                c = letters(text.as_py())
                held[lang.as_py()].append(c)
                size += len(c)
                if size >= LETTERS_AT_ONCE:
                    yield from counts(held)
                    held, size = defaultdict(list), 0
        yield from counts(held)

    def counts(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            values, n = np.unique(grams(np.concatenate(parts)), return_counts=True)
            names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(n), np.int32)), pa.array([lang])).cast("string")
            yield pa.RecordBatch.from_arrays([names, pa.array(values), pa.array(n)], ["lang", "gram", "n"])

    parts = rows.mapInArrow(count, "lang string, gram bigint, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, training: Column) -> Profiles:
    """Profiles of the non-null ``lang`` values in the ``training`` rows of ``docs``."""
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = counted(rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    tops = defaultdict(dict)
    for lang, gram, rank in top.select("lang", "gram", "rank").collect():
        tops[lang][rank] = gram
    return Profiles.of({lang: [g for _, g in sorted(by.items())] for lang, by in tops.items()})


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``has_letter``, judged from ``text`` alone."""
    held = F.struct(*docs.columns).alias("row")
    rows = docs.select(held, F.col("text").cast("string").alias("own"))
    kind = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, has_letter boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.judged(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(("string", "float64", "bool"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "lang_pred", "score", "has_letter"])

    return rows.mapInArrow(judge, kind)


def crc_of(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``; a quarter of the documents is held out."""
    held_out = F.coalesce(crc_of("doc_id") % 4 == 2, F.lit(False))
    own = docs.select("doc_id", "text", "lang")
    judged = identify(own.drop("lang"), learn(own, ~held_out))
    return judged.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has no letter; a missing ``lang`` is filled in where one can be learned."""
    judged = identify(docs, learn(docs, F.lit(True))).where("has_letter")
    lang = F.coalesce("row.lang", F.nullif("lang_pred", F.lit(UNDETERMINED)))
    return judged.select(*(lang.alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns))
