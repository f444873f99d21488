"""SimHash near-duplicates, found through an inverted index on byte positions.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits differ in
at most two bytes, so a linked pair shares at least ``8 - 2 = 6`` of them: the guaranteed minimum
of the count filter. Posting lists of single (position, byte) entries would each hold 1/256 of all
documents, and tallying pairs over them would be quadratic. The lists here are kept per choice
of six positions instead, so meeting in a list *is* the tally reaching its minimum, and a list has at
most 2^16 different fingerprints (two bytes are free), whatever the corpus.

* Equal fingerprints are one class before anything is indexed.
* A list is linked where it lies: its pairs are verified by their bits, and only a spanning
  star per linked group leaves the task, never all pairs.
* Classes are joined to components by alternating large-star and small-star rounds.

Defined results: null and wordless texts have fingerprint zero and are linked like any other; rows
of one ``doc_id`` are one document; rows without ``doc_id`` get a fingerprint, but no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygauge.llm.storage import documents_only, saved

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
BYTES = 8
#: The pairs of byte positions that a posting list leaves free.
FREE_PAIRS = tuple(combinations(range(BYTES), MOST_BITS))
SHINGLES_AT_ONCE = 1 << 16
#: Lists up to this length are compared entry by entry; longer ones look up each entry's neighbours.
SHORT_LIST = 64


def fingerprint(text: str | None) -> int:
    """The SimHash of a text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - SHINGLE_WORDS + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = words[start : start + SHINGLES_AT_ONCE + SHINGLE_WORDS - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE_WORDS)), strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over_half = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return documents_only(docs).mapInArrow(compute, "doc_id bigint, fp bigint")


def kept_bytes(free: tuple[int, ...]) -> int:
    """The mask of the bytes that are not free, as a signed number."""
    mask = (1 << 64) - 1
    for position in free:
        mask &= ~(0xFF << (8 * position))
    return mask - (1 << 64) if mask >> 63 else mask


KEPT_BYTES = np.array([kept_bytes(free) for free in FREE_PAIRS], dtype=np.int64)


def neighbour_masks(free: tuple[int, ...]) -> list[int]:
    """The changes of one or two bits within the free bytes."""
    bits = [1 << (8 * p + b) for p in free for b in range(8)]
    return bits + [a | b for a, b in combinations(bits, 2)]


def grouped(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node each of ``n`` nodes reaches over the edges ``a``-``b``."""
    label = np.arange(n)
    while True:
        before = label
        low = np.minimum(label[a], label[b])
        label = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def tallied(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs share enough positional bytes and then differ in few enough bits."""
    change = fps[i] ^ fps[j]
    shared = (change.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    enough = shared >= BYTES - MOST_BITS
    enough[enough] = np.bitwise_count(change[enough]) <= MOST_BITS
    return enough


def links_of_lists(slot: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """For whole posting lists, sorted by list and fingerprint: the first entry each is linked to."""
    n = len(fps)
    key = fps & KEPT_BYTES.view(np.uint64)[slot]
    new = np.ones(n, dtype=bool)
    new[1:] = (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, n))
    left = np.repeat(lengths, lengths) - (np.arange(n) - np.repeat(starts, lengths))
    short = np.repeat(lengths <= SHORT_LIST, lengths)
    a, b = [], []
    for lag in range(1, min(SHORT_LIST, int(lengths.max(initial=1)))):
        i = np.flatnonzero(short & (left > lag))
        hit = tallied(fps, i, i + lag)
        a.append(i[hit])
        b.append(i[hit] + lag)
    for start, length in zip(starts[lengths > SHORT_LIST], lengths[lengths > SHORT_LIST], strict=True):
        own = fps[start : start + length]
        for change in neighbour_masks(FREE_PAIRS[slot[start]]):
            other = own ^ np.uint64(change)
            at = np.minimum(np.searchsorted(own, other), length - 1)
            i = np.flatnonzero(own[at] == other)
            a.append(start + i)
            b.append(start + at[i])
    if not a:
        return np.arange(n)
    return grouped(n, np.concatenate(a), np.concatenate(b))


def linked_classes(classes: DataFrame) -> DataFrame:
    """Links ``a``-``b`` between the ``node`` ids of classes whose ``fp`` differ in few bits.

    Not all pairs: per posting list a star over each linked group, which has the same components.
    """
    postings = classes.select(
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(kept_bytes(free)) for free in FREE_PAIRS])).alias("slot", "shared"),
        "fp",
        "node",
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        for batch in batches:
            slot, shared, fps, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if rest:
                slot, shared, fps, node = (np.concatenate(x) for x in zip(rest, (slot, shared, fps, node), strict=True))
            last = np.flatnonzero((slot != slot[-1]) | (shared != shared[-1]))
            cut = last[-1] + 1 if len(last) else 0
            yield from stars(slot[:cut], fps[:cut], node[:cut])
            rest = [slot[cut:], shared[cut:], fps[cut:], node[cut:]]
        if rest:
            yield from stars(rest[0], rest[2], rest[3])

    def stars(slot: np.ndarray, fps: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fps):
            order = np.lexsort((fps.view(np.uint64), fps & KEPT_BYTES[slot], slot))
            slot, fps, node = slot[order], fps[order].view(np.uint64), node[order]
            first = links_of_lists(slot, fps)
            other = np.flatnonzero(first != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[first[other]])], ["a", "b"])

    lists = postings.repartition("slot", "shared").sortWithinPartitions("slot", "shared")
    return lists.mapInArrow(link, "a bigint, b bigint").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node but the roots.

    Alternating large-star and small-star rounds; every round is a table of its own, and only its
    row count and a checksum come to the driver.
    """

    def stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
        edges = saved(edges.where("u != v").distinct(), "links")
        check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        return edges, tuple(edges.agg(F.count("*"), check).first())

    edges, state = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while state[0]:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = saved(large.distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", "low"))
        edges, after = stored(small)
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, one row per row."""
    prints = saved(fingerprints(docs), "fingerprints")
    classes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = saved(classes, "classes")
    # A document whose rows have different texts links the classes of all of them.
    several = prints.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x != y")
    several = prints.join(several.where("doc_id is not null"), "doc_id", "left_semi").join(classes, "fp")
    lowest = several.groupBy("doc_id").agg(F.min("node").alias("b"))
    repeated = several.join(lowest, "doc_id").select(F.col("node").alias("a"), "b")
    links = linked_classes(classes).union(repeated)
    roots = smallest_reachable(links)
    labels = classes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.join(labels, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest document of each group only, with all its columns.

    Of several rows of that document the one with the smallest text stays. Rows without ``doc_id``
    stay: they belong to no group.
    """
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy("text")
    named = docs.join(kept, "doc_id", "left_semi").withColumn("__row", F.row_number().over(first))
    return named.where("__row = 1").drop("__row").select(docs.columns).unionByName(docs.where("doc_id is null"))
