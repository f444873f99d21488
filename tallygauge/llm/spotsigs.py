"""SpotSigs fingerprints: chains of content words after common words.

A spot is a common word (an anchor), or the start of a line; its signature is the anchor and the next ``CHAIN``
content words, common words passed over. A content word that no spot's chain reaches has a signature of its own,
it and the ``CHAIN`` content words before it; so has a common word after the last content word, with the words
before it. So every word of a text is in a signature, in any language. A text's fingerprint is the set of its signatures, as
sorted 32-bit hashes in base64. Two sets are compared by their Jaccard likeness. With a least
likeness above 0, a pair whose lengths rule it out is not compared: sets that reach it are in the same or
neighbouring partitions of length. That is a test of a pair in hand; fingerprints are not dealt by partition
in Spark and not searched for, and two sets that pass are compared whole.

Anchors are the listed words and the ``MOST_ANCHORS`` most frequent words of all documents, but no more of these than
one in ``WORDS_AN_ANCHOR`` different words: where there are few words, being frequent does not make one common.

Documents are compared with their successor by ``doc_id``. Ranges of ``doc_id`` are dealt to
tasks, sorted, and run through in order; the first document of each range is also sent to the
range before it, so no order over all documents goes through one task. The bounds of the ranges,
a few per shuffle partition, are what the driver sees.

Defined results: a null text is empty; an empty or blank text has no signatures, and two sets without
any are alike (1); a text without words has one signature, itself; rows without ``doc_id`` come last;
rows of one ``doc_id`` follow each other by text; a table of one row has itself as successor; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b64decode, b64encode
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.storage import documents_only, saved

CHAIN = 2
RANGES_PER_PARTITION = 4
#: Most frequent words that are anchors at most, and different words for each of them at least.
MOST_ANCHORS = 256
WORDS_AN_ANCHOR = 100
#: Different words that a task counts at a time.
WORDS_AT_ONCE = 200_000
WORD = re.compile(r"\w+|\n")
#: Common words that are anchors however seldom they are.
ANCHORS = frozenset(
    (
        "a an and are as at be by for from has he in is it of on or that the there this to was were will with "
        "der die das ein eine und ist zu den dem des von mit auf für nicht auch sich im es als "
        "le la les un une des et est de du en que qui dans pour par sur ne pas au aux ce il "
        "el los las una y es del al con no por para se su como lo más o"
    ).split()
)


def signatures(text: str | None, anchors: frozenset[str] = ANCHORS) -> set[str]:
    """The anchor and chain at every spot of a text, and the chains of the words that these do not reach."""
    own = (text or "").lower()
    tokens = WORD.findall("\n" + own)
    every = [t for t in tokens if t != "\n"]
    words = [t for t in every if t not in anchors]
    found, after, reached, lines = set(), 0, 0, 0
    for i, token in enumerate(tokens):
        if token == "\n":
            lines += 1
            if i + 1 < len(tokens) and tokens[i + 1] != "\n":
                found.add(" ".join(("^", *(words[after : after + CHAIN] or tokens[i + 1 : i + 1 + CHAIN]))))
                reached = after + CHAIN
        elif token not in anchors:
            if after >= reached:
                found.add(" ".join(words[max(0, after - CHAIN) : after + 1]))
            after += 1
        elif after < len(words):
            found.add(" ".join((token, *words[after : after + CHAIN])))
            reached = after + CHAIN
        elif i > lines:
            found.add(" ".join(every[max(0, i - lines - CHAIN) : i - lines + 1]))
    if not every and own.strip():
        found.add(own.strip())
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(WORD.findall((text.as_py() or "").lower()))
                if len(held) >= WORDS_AT_ONCE:
                    yield counts(held)
                    held = Counter()
        yield counts(held)

    def counts(held: Counter) -> pa.RecordBatch:
        held.pop("\n", None)
        return pa.RecordBatch.from_arrays([pa.array([*held], "string"), pa.array([*held.values()], "int64")], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def anchors_of(docs: DataFrame) -> frozenset[str]:
    """The listed anchors and the most frequent words of ``docs``; words of equal count by name."""
    counts = saved(word_counts(docs), "words")
    most = min(MOST_ANCHORS, counts.count() // WORDS_AN_ANCHOR)
    return ANCHORS.union(r.word for r in counts.orderBy(F.desc("n"), "word").limit(most).collect())


def fingerprint(text: str | None, anchors: frozenset[str] = ANCHORS) -> str:
    hashes = {xxhash.xxh32_intdigest(s.encode("utf-8", "surrogatepass")) for s in signatures(text, anchors)}
    return b64encode(np.array(sorted(hashes), dtype="<u4").tobytes()).decode()


def hashes_of(print_: str) -> np.ndarray:
    return np.frombuffer(b64decode(print_), dtype="<u4")


def partition_of(length: int, least: float) -> int:
    """Sets that reach ``least`` are in the same partition or in neighbouring ones."""
    if least <= 0 or length == 0:
        return 0
    return int(np.floor(np.log(length) / np.log(1 / least))) if least < 1 else length


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The Jaccard likeness of two sorted sets, or 0 if it is below ``least``."""
    if not len(a) and not len(b):
        return 1.0
    short, long = sorted((len(a), len(b)))
    if not short or abs(partition_of(short, least) - partition_of(long, least)) > 1 or short < least * long:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (short + long - common)
    return value if value >= least else 0.0


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def range_bounds(docs: DataFrame) -> list[int]:
    """Some ``doc_id`` values, the smallest among them, that cut the documents into even ranges."""
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    least, cuts = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 100 * ranges)).first()
    return sorted({least, *cuts}) if least is not None else []


def compared(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """Fingerprints of every text and its edited text, and how like it they and the next text's are."""
    own = documents_only(docs)
    bounds = range_bounds(own)
    starts = set(bounds)
    anchors = anchors_of(own)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            last = max(0, len(bounds) - 1)
            at = [last if i is None else max(0, bisect_right(bounds, i) - 1) for i in ids]
            extra = [n for n, i in enumerate(ids) if i in starts or not bounds]
            rows = pa.array([*range(len(ids)), *extra])
            to = [*at, *((at[n] or last + 1) - 1 for n in extra)]
            kind = [*(int(i is None) for i in ids), *(2 for _ in extra)]
            taken = batch.take(rows)
            columns = [pa.array(to, pa.int32()), pa.array(kind, pa.int32()), *taken.columns]
            yield pa.RecordBatch.from_arrays(columns, ["part", "kind", "doc_id", "text"])

    dealt = own.mapInArrow(deal, "part int, kind int, doc_id bigint, text string").repartition("part")
    dealt = dealt.sortWithinPartitions("part", "kind", "doc_id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, None
        for batch in batches:
            rows = []
            for to, kind, doc_id, text in zip(*batch.columns, strict=True):
                new = (doc_id.as_py(), text.as_py() or "", None)
                if to.as_py() != part:
                    part, held = to.as_py(), None
                elif held is not None:
                    print_ = fingerprint(new[1], anchors)
                    rows.append(row(held, new[1], print_))
                    new = (*new[:2], print_)
                held = new if kind.as_py() < 2 else None
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    def row(held: tuple, following: str, next_print: str) -> tuple:
        doc_id, text, print_ = held
        print_ = fingerprint(text, anchors) if print_ is None else print_
        changed = edited(text, following)
        edited_print = fingerprint(changed, anchors)
        a, b, c = map(hashes_of, (print_, edited_print, next_print))
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, print_, edited_print, likeness(a, b, least), likeness(a, c, least)

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kind = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(compare, kind)
