"""Spelling variants of frequent words, found through an index of variable-length grams.

1. *Words.* Runs of letters of all texts are counted, in every task before the shuffle. (``word_counts`` also misspells one run in 31
   of a document, as the query asks; ``edit_one_in`` is a parameter.)
2. *Gram dictionary.* A gram is lengthened as long as it is frequent: grams of ``SHORTEST`` to ``LONGEST`` - 1 characters
   that occur more often than one in ``DICTIONARY`` places are extended by the next character, all others are
   pruned there. A length has fewer than ``DICTIONARY`` frequent grams whatever the words, so the dictionary has a bound and goes to all tasks.
3. *Grams of a word.* At each of its characters the gram that the dictionary gives, behind the word filled up with an
   end sign. One edit changes only the grams that cover its place; the largest number of grams over one place is
   the word's bound of affected grams. A near word shares all others, at the same place or one further.
4. *Merging lists.* Grams have one order, frequent ones last. Of two near words with bounds ``a`` and ``b`` the first shared gram is among
   the ``a + 1`` first of one and the ``b + 1`` first of the other, so only these go into lists. In a list, words meet at
   the same place or one further if they are equal without one character, which is before or after the gram. A pair has to
   share as many grams as the bounds ask for, and counts in the first list that both words are in.
   The list of a gram with more than ``LONG_LIST`` places is not held: its words go on with what is left when one character is taken out (as
   a hash), and near words still meet there. Such a list has at most one word per letter of the alphabet, all near each other.
5. *Forms.* The most frequent near word, if it is ten times as frequent. Counts grow tenfold along a chain
   of forms, which bounds its length; its end is found by doubling steps.

Defined results: a null text has no words; a row without ``doc_id`` has an empty one; repeated rows count again; words may be of any
length; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, combinations
from math import ceil, log2, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.storage import documents_only, saved

LEAST_LENGTH = 7
LEAST_COUNT = 2
EDIT_ONE_IN = 31
FORM_FACTOR = 10
SHORTEST, LONGEST = 2, 6
DICTIONARY = 1 << 14
LONG_LIST = 4096
#: Different words or grams that a task counts at a time.
COUNTED_AT_ONCE = 200_000
END = "\0"
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
BASE = 0x9E3779B97F4A7C15


def counted(items: Callable[[pa.RecordBatch], Iterator[Counter | list[str]]], name: str) -> Callable:
    """A task function that sums the counts of its batches, a bounded number of keys at a time."""

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*held], "string"), pa.array([*held.values()], "int64")], [name, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for own in items(batch):
                held.update(own)
                if len(held) >= COUNTED_AT_ONCE:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return count


def runs_of(doc_id: int | None, text: str | None, least: int, edit_one_in: int) -> Counter:
    """The runs of letters of a text, lower-cased in ASCII, one in ``edit_one_in`` of them without one character."""
    own = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
    found = Counter(re.findall(f"[a-z\\u00C0-\\u00FF]{{{least},}}", own))
    if not edit_one_in:
        return found
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    edited = Counter()
    for run in [*found]:
        h = crc32(run.encode(), start)
        if h % edit_one_in == 0:
            n, at = found.pop(run), h % len(run)
            if len(run) > least:
                edited[run[:at] + run[at + 1 :]] += n
    found.update(edited)
    return found


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH, edit_one_in: int = 0) -> DataFrame:
    """``word`` and ``n``: the words of at least ``least`` letters of all texts."""

    def items(batch: pa.RecordBatch) -> Iterator[Counter]:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield runs_of(doc_id, text.as_py(), least, edit_one_in)

    return documents_only(docs).mapInArrow(counted(items, "word"), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class GramAt(dict):
    """The gram that begins some characters, found once per worker (a bounded cache)."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts

    def __missing__(self, text: str) -> str:
        if len(self) >= COUNTED_AT_ONCE:
            self.clear()
        end = SHORTEST
        while end < LONGEST and text[:end] in self.counts:
            end += 1
        self[text] = text[:end]
        return text[:end]

    def __reduce__(self):
        return GramAt, (self.counts,)


class Grams:
    """The gram dictionary: frequent grams with their counts, and the count above which a gram is frequent."""

    def __init__(self, counts: dict[str, int], most: int):
        self.counts, self.most = counts, most
        self.longest = GramAt(counts)

    def has_long_list(self, gram: str) -> bool:
        """Grams that are not in the dictionary have ``most`` places at most."""
        return self.counts.get(gram, self.most) > LONG_LIST

    def of(self, word: str) -> list[str]:
        """The gram at each place of a word."""
        text = word + END * LONGEST
        return [self.longest[text[p : p + LONGEST]] for p in range(len(word))]

    def listed(self, word: str) -> tuple[list[str], int, list[tuple[str, int]]]:
        """The grams of a word, how many of them one edit can change, and gram and place of one more than that, the first in order."""
        grams = self.of(word)
        bound = affected(grams)
        counts = self.counts
        order = sorted([(counts.get(g, 0), g, p) for p, g in enumerate(grams)])
        return grams, bound, [(g, p) for _, g, p in order[: bound + 1]]


def gram_dictionary(words: DataFrame) -> Grams:
    """The frequent grams of each length, fewer than ``DICTIONARY`` of a length."""

    def items(batch: pa.RecordBatch) -> Iterator[list[str]]:
        for word in batch.column(0).to_pylist():
            text, n = word + END * LONGEST, len(word)
            yield [text[p : p + size] for size in range(SHORTEST, LONGEST + 1) for p in range(n)]

    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    most = places // DICTIONARY + 1
    grams = words.select("word").mapInArrow(counted(items, "gram"), "gram string, n bigint")
    frequent = grams.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return Grams({r.gram: r.n for r in frequent.collect()}, most)


def affected(grams: list[str]) -> int:
    """How many grams one edit can change: the most that cover one place."""
    ends = [0] * (len(grams) + LONGEST + 1)
    for p, gram in enumerate(grams):
        ends[p + len(gram)] += 1
    most = covering = 0
    for p in range(len(grams)):
        covering += 1 - ends[p]
        most = max(most, covering)
    return most


def shared_grams(short: list[str], long: list[str]) -> int:
    """Grams of the shorter word that the longer one has at the same place, or one further if it is longer."""
    if len(short) == len(long):
        return sum(a == b for a, b in zip(short, long, strict=True))
    return sum(g == long[p] or g == long[p + 1] for p, g in enumerate(short))


def one_edit(short: str, long: str) -> bool:
    """Whether the words differ by one replaced character, or one that the longer has more.

    One half is equal then, and the edit is in the other.
    """
    more = len(long) - len(short)
    if more > 1 or short == long:
        return False
    while len(short) > 1:
        half = len(short) >> 1
        if short[:half] == long[:half]:
            short, long = short[half:], long[half:]
        elif short[half:] == long[half + more :]:
            short, long = short[:half], long[: half + more]
        else:
            return False
    return not more or not short or short in (long[0], long[1])


class Merged:
    """Finds out whether two words are near, and in which list they meet first."""

    def __init__(self, grams: Grams):
        self.grams = grams
        self.listed = lru_cache(maxsize=50_000)(self.with_lists)

    def with_lists(self, word: str) -> tuple[list[str], int, list[tuple[str, int]], frozenset]:
        grams, bound, lists = self.grams.listed(word)
        return grams, bound, lists, frozenset(lists)

    def first_list(self, short: str, long: str) -> tuple[str, int] | None:
        """The first gram of the shorter word's lists that the longer one's have too, with its place."""
        own, there, more = self.listed(short)[2], self.listed(long)[3], len(long) > len(short)
        for entry in own:
            if entry in there or (more and (entry[0], entry[1] + 1) in there):
                return entry
        return None

    def share_enough(self, short: str, long: str) -> bool:
        """Whether two words share as many grams as the bounds of both ask for."""
        own, other = self.listed(short), self.listed(long)
        return shared_grams(own[0], other[0]) >= max(len(own[0]) - own[1], len(other[0]) - other[1])

    def meet_first(self, short: str, long: str) -> tuple[str, int] | None:
        """Gram and place of the first list of two near words; None if they are not near."""
        if not one_edit(short, long) or not self.share_enough(short, long):
            return None
        return self.first_list(short, long)


@lru_cache(maxsize=4)
def powers(size: int) -> np.ndarray:
    factors = np.full(size, BASE, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def shortened(word: str) -> tuple[int, list[int]]:
    """A hash of the word, and of what is left when each of its characters is taken out."""
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    n = len(codes)
    power = powers(1 << n.bit_length())[: n + 1]
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power[:n])))
    # What follows a character moves one place to the front when it is taken out.
    after = np.zeros(n, np.uint64)
    after[:-1] = np.cumsum((codes[1:] * power[: n - 1])[::-1])[::-1]
    return int(upto[n].view(np.int64)), (upto[:n] + after).view(np.int64).tolist()


LISTED = "gram string, at int, n bigint, word string"


def listed_words(words: DataFrame, grams: Grams, long: bool) -> DataFrame:
    """``gram``, ``at``, ``n`` and ``word``: the words of the lists that are long or are not."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (gram, at, n, word)
                for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True)
                for gram, at in grams.listed(word)[2]
                if grams.has_long_list(gram) == long
            ]
            yield batch_of(out, LISTED)

    return words.select("word", "n").mapInArrow(rows, LISTED)


def batch_of(rows: list[tuple], kind: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
    fields = [c.split() for c in kind.split(", ")]
    columns = [*zip(*rows, strict=True)] if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


NEAR = "word string, less bigint, other string"


def both_ways(a: str, n_a: int, b: str, n_b: int) -> list[tuple]:
    return [(a, -n_b, b), (b, -n_a, a)]


def near_in_list(gram: str, rows: list[tuple[int, int, str]], merged: Merged) -> Iterator[tuple]:
    """Near words of one list, both ways; ``rows`` has place, count and word.

    The words have the gram in common, so what they differ by is before or after it: near words are
    equal without that character, and only characters outside of the gram are left out to look for them.
    """
    places: dict[tuple[int, int], set[str]] = defaultdict(set)
    for at, _, word in rows:
        places[at, len(word)].add(word)
    counts = {word: n for _, n, word in rows}
    for (at, size), short in [*places.items()]:
        met = []
        if len(short) > 1:
            left = defaultdict(list)
            for word in short:
                for i in chain(range(at), range(at + len(gram), size)):
                    left[word[:i] + END + word[i + 1 :]].append(word)
            met += [(a, b) for group in left.values() if len(group) > 1 for a, b in combinations(group, 2)]
        for p in (at, at + 1):
            for other in places.get((p, size + 1), ()):
                for i in chain(range(p), range(p + len(gram), size + 1)):
                    if (word := other[:i] + other[i + 1 :]) in short:
                        met.append((word, other))
        for word, other in met:
            if merged.first_list(word, other) == (gram, at) and merged.share_enough(word, other):
                yield from both_ways(word, counts[word], other, counts[other])


def near_in_short_lists(words: DataFrame, grams: Grams) -> DataFrame:
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, gram, held, out = Merged(grams), None, [], set()
        for batch in batches:
            for own, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != gram:
                    out.update(near_in_list(gram, held, merged))
                    gram, held = own, []
                held.append(entry)
            if len(out) >= 10_000:
                yield batch_of([*out], NEAR)
                out = set()
        out.update(near_in_list(gram, held, merged))
        yield batch_of([*out], NEAR)

    # A list is one task's, with as many words as the dictionary's bound or LONG_LIST allow.
    lists = listed_words(words, grams, False).repartition("gram").sortWithinPartitions("gram")
    return lists.mapInArrow(near, NEAR)


SPLIT = "list bigint, place int, left bigint, longer boolean, id bigint"


def near_in_long_lists(words: DataFrame, grams: Grams) -> DataFrame:
    ids = saved(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "ids")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, uid in zip(batch["word"].to_pylist(), batch["id"].to_pylist(), strict=True):
                lists = [(g, at) for g, at in grams.listed(word)[2] if grams.has_long_list(g)]
                whole, left = shortened(word) if lists else (0, [])
                n, out = len(word), []
                for gram, at in lists:
                    own = list_id(gram, at, n)
                    out += [(own, i, x, False, uid) for i, x in enumerate(left)]
                    out.append((own, -1, whole, False, uid))
                    # A longer word stands in the lists of the shorter ones, at the same place and one before.
                    for p in (at, at - 1):
                        own = list_id(gram, p, n - 1)
                        out += [(own, -1, x, True, uid) for i, x in enumerate(left) if not i or word[i] != word[i - 1]]
                if out:
                    yield batch_of(out, SPLIT)

    rows = saved(ids.select("word", "id").mapInArrow(batched_rows(split), SPLIT), "split")
    key = ["list", "place", "left"]
    first = rows.where("NOT longer").select(*key, F.col("id").alias("a"))
    other = rows.where("place >= 0 OR longer").select(*key, F.col("id").alias("b"), "longer")
    met = first.join(other, key).where("longer OR a < b").select("a", "b").distinct()
    texts = met.join(ids.select(F.col("id").alias("a"), F.col("word").alias("own"), F.col("n").alias("n_own")), "a")
    texts = texts.join(ids.select(F.col("id").alias("b"), F.col("word").alias("other"), F.col("n").alias("n_other")), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = Merged(grams)
        for batch in batches:
            out = []
            for own, n, other, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = merged.meet_first(own, other)
                if found is not None and grams.has_long_list(found[0]):
                    out += both_ways(own, n, other, m)
            yield batch_of(out, NEAR)

    return texts.select("own", "n_own", "other", "n_other").mapInArrow(near, NEAR)


def list_id(gram: str, at: int, size: int) -> int:
    """A list as a number; words of lists that share one by chance are only compared in vain."""
    return xxhash.xxh64_intdigest(f"{gram} {at} {size}") >> 1


def batched_rows(make: Callable, rows: int = 20_000) -> Callable:
    """``make`` with its many small batches joined to larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in make(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``less`` and ``other``: each near word of a word in ``word`` and ``n``, with its count below zero."""
    grams = gram_dictionary(words)
    near = near_in_short_lists(words, grams)
    if grams.most > LONG_LIST or any(len(g) == LONGEST and grams.has_long_list(g) for g in grams.counts):
        near = near.union(near_in_long_lists(words, grams))
    return near


def roots(links: DataFrame, longest: int) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``; chains have at most ``longest`` steps."""
    steps = saved(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(0, ceil(log2(longest)))):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = saved(steps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return steps


def variants(counts: DataFrame, least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the words in ``word`` and ``n``."""
    words = saved(counts.where(F.col("n") >= least_count), "words")
    best = F.min(F.struct("less", "other")).alias("best")
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = saved(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    most = rows.agg(F.max("n")).first()[0] or 1
    ends = roots(rows.where("form IS NOT NULL"), 1 + int(log10(most) / log10(factor)))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs, edit_one_in=EDIT_ONE_IN))
