"""Substring deduplication with prefix-partitioned suffix trees over words.

A repeat is a window of ``WINDOW`` words whose words also start in a document with a smaller
``doc_id``. Suffixes are cut off at that depth: two suffixes meet in an internal node of depth
``WINDOW`` exactly where their first ``WINDOW`` words are equal, and consecutive windows of such nodes
make up the maximal repeats.

1. *Prefixes.* A suffix enters a group by a prefix of ``PREFIX`` words, taken where its window's
   hashes are lowest, so equal windows take it at the same place and one prefix serves several
   consecutive windows (about one prefix per five words). Prefixes are counted; one that is in a
   single document is a leaf, and its windows never leave their task.
2. *Groups.* The windows of a shared prefix go to its group as one stretch of text. A prefix of more
   than ``MOST_DOCS`` documents is too frequent for one group's memory: it is lengthened to the whole
   window, so such a group has one node. Before that each lot keeps, of equal windows, only those of
   its smallest document: a passage in a third of all documents is one row per lot, not per document.
3. *Subtrees.* A group's suffixes are sorted; neighbours with ``WINDOW`` equal words are one node,
   and what lies in a larger document than the node's smallest is removed.

Hashes only decide what is compared; what is removed is decided on the words themselves. Documents are
dealt into lots of ``LOT_DOCS``; the three passes over texts read one and the same exchange.

Defined results: null and wordless texts have no words; texts of fewer than ``WINDOW`` words keep
them all; rows without ``doc_id`` lose nothing and cause nothing to be removed; rows of one ``doc_id``
never remove words of each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 13
PREFIX = 5
LOT_DOCS = 512
MOST_DOCS = 4096
#: Suffixes sorted at a time; a group with more is sorted in blocks.
BLOCK = 200_000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=8)
def power_table(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def powers(base: int, n: int) -> np.ndarray:
    return power_table(base, 1 << max(10, (n - 1).bit_length()))[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(b" ".join(words), dtype=np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * powers(BASE, len(data)), out=sums[1:])
    return mixed((sums[starts + lengths] - sums[starts]) * powers(INVERSE, len(data) + 1)[starts])


def window_prefixes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the hash of its prefix and where that prefix is."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = len(hashes) - PREFIX + 1
    prefix = np.zeros(size, dtype=np.uint64)
    for i in range(PREFIX):
        prefix = mixed(prefix * np.uint64(BASE) + hashes[i : i + size])
    choice = np.lib.stride_tricks.sliding_window_view(prefix, WINDOW - PREFIX + 1)
    at = choice.argmin(axis=1) + np.arange(n)
    return prefix[at], at


class Lot:
    """The documents of a lot, ordered by ``doc_id`` and text."""

    def __init__(self, table: pa.Table):
        ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
        own = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, own[i]))
        self.ids = [ids[i] for i in self.order]
        self.words = [own[i].split() for i in self.order]

    def windows(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row, ``doc_id``, prefix hashes and places of every document that can have repeats."""
        for row, (doc_id, words) in enumerate(zip(self.ids, self.words, strict=True)):
            if doc_id is not None and len(words) >= WINDOW:
                yield row, doc_id, *window_prefixes(word_hashes(words))


def prefixes_of_lot(table: pa.Table) -> pa.Table:
    """``h`` of each prefix and how many documents of the lot have it."""
    found = [(np.unique(h), doc_id) for _, doc_id, h, _ in Lot(table).windows()]
    if not found:
        return pa.table({n: pa.array([], t) for n, t in (("lot", pa.int64()), ("h", pa.int64()), ("docs", pa.int32()))})
    every = np.concatenate([h for h, _ in found])
    doc = np.repeat([d for _, d in found], [len(h) for h, _ in found])
    order = np.lexsort((doc, every))
    every, doc = every[order], doc[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    another = np.append(True, (every[1:] != every[:-1]) | (doc[1:] != doc[:-1]))
    docs = np.add.reduceat(another.astype(np.int32), first)
    lot = np.full(len(first), table["lot"][0].as_py())
    return pa.table({"lot": lot, "h": every[first].view(np.int64), "docs": pa.array(docs, pa.int32())})


SUFFIX = "key bigint, doc_id bigint, lot bigint, row int, pos int, n int, words binary"
SUFFIX_SCHEMA = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("lot", pa.int64()), ("row", pa.int32()), ("pos", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]
)


def runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def suffixes_of_lot(table: pa.Table, shared: pa.Table) -> pa.Table:
    """The stretches of windows with shared prefixes; without ``words`` what is removed already.

    A stretch has ``n`` windows, whose prefix is its ``key``; what is removed has ``n`` words.
    """
    known = np.sort(shared["h"].to_numpy().view(np.uint64))
    hot = np.sort(shared["h"].to_numpy().view(np.uint64)[shared["hot"].to_numpy()])
    rows = defaultdict(list)
    if not len(known) or not table.num_rows:
        return pa.table({f.name: pa.array([], f.type) for f in SUFFIX_SCHEMA}, schema=SUFFIX_SCHEMA)
    lot = table["lot"][0].as_py()
    first_doc: dict[bytes, int] = {}
    docs = Lot(table)

    def add(*values) -> None:
        for name, value in zip(SUFFIX_SCHEMA.names, values, strict=True):
            rows[name].append(value)

    for row, doc_id, h, at in docs.windows():
        words = docs.words[row]
        is_shared = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        if not is_shared.any():
            continue
        is_hot = np.isin(h, hot)
        text = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        ends, starts = ends.tolist(), np.append(0, ends[:-1] + 1).tolist()
        gone = np.zeros(len(h), dtype=bool)
        for s in np.flatnonzero(is_shared).tolist():
            window = text[starts[s] : ends[s + WINDOW - 1]]
            gone[s] = first_doc.setdefault(window, doc_id) < doc_id
        for s, e in runs(gone):
            add(xxhash.xxh64_intdigest(b"%d %d" % (lot, row)) >> 1, doc_id, lot, row, s, e - s + WINDOW - 1, None)
        stay = is_shared & ~gone
        for s in np.flatnonzero(stay & is_hot).tolist():
            window = text[starts[s] : ends[s + WINDOW - 1]]
            add(xxhash.xxh64_intdigest(window) >> 1, doc_id, lot, row, s, 1, window)
        stay &= ~is_hot
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (at[1:] == at[:-1]) & stay[:-1]
        begins = np.flatnonzero(stay & ~same)
        following = np.cumsum(stay & ~same)
        counts = np.bincount(following[stay], minlength=len(begins) + 1)[1:]
        for s, n in zip(begins.tolist(), counts.tolist(), strict=True):
            add(int(h[s] >> np.uint64(1)), doc_id, lot, row, s, n, text[starts[s] : ends[s + n + WINDOW - 2]])
    return pa.table(rows, schema=SUFFIX_SCHEMA) if rows else pa.table({f.name: pa.array([], f.type) for f in SUFFIX_SCHEMA}, schema=SUFFIX_SCHEMA)


def subtree(suffixes: list[tuple[bytes, int, int, int]], smallest: dict[bytes, int]) -> Iterator[tuple[int, int]]:
    """Of suffixes (first words, ``doc_id``, stretch, place) the stretch and place of what is removed.

    ``smallest`` has the smallest document of each node of the group's earlier blocks.
    """
    suffixes.sort()
    node = first = None
    for words, doc_id, stretch, place in suffixes:
        if words != node:
            node = words
            first = smallest.setdefault(words, doc_id)
        if doc_id > first:
            yield stretch, place


def removed_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From stretches sorted by ``key`` and ``doc_id``: ``lot``, ``row``, ``pos`` and ``n`` words removed."""
    key, smallest, block, stretches, out = None, {}, [], [], []

    def end_block() -> None:
        gone = defaultdict(list)
        for stretch, place in subtree(block, smallest):
            gone[stretch].append(place)
        for stretch, places in gone.items():
            lot, row, pos = stretches[stretch]
            flags = np.zeros(max(places) + 1, dtype=bool)
            flags[places] = True
            out.extend((lot, row, pos + s, e - s + WINDOW - 1) for s, e in runs(flags))
        block.clear()
        stretches.clear()

    for batch in batches:
        for own, doc_id, lot, row, pos, n, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if words is None:
                out.append((lot, row, pos, n))
                continue
            if own != key or len(block) >= BLOCK:
                end_block()
                if own != key:
                    key = own
                    smallest.clear()
            if n == 1:
                block.append((words, doc_id, len(stretches), 0))
            else:
                every = words.split(b" ")
                block.extend((b" ".join(every[i : i + WINDOW]), doc_id, len(stretches), i) for i in range(n))
            stretches.append((lot, row, pos))
        if out:
            yield removed_rows(out)
            out.clear()
    end_block()
    if out:
        yield removed_rows(out)


def removed_rows(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["lot", "row", "pos", "n"])


def in_lots(docs: DataFrame) -> DataFrame:
    """``lot``, ``doc_id``, ``text`` and ``rest``, all columns but the text."""
    lots = max(1, -(-docs.count() // LOT_DOCS))
    lot = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), F.lit(lots))
    return docs.select(
        lot.cast("bigint").alias("lot"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*(c for c in docs.columns if c != "text")).alias("rest"),
    )


def removed_words(lots: DataFrame) -> DataFrame:
    """``lot``, ``row``, ``pos`` and ``n``: the stretches of words that go."""
    found = lots.groupBy("lot").applyInArrow(prefixes_of_lot, "lot bigint, h bigint, docs int")
    counted = found.select("lot", "h", F.sum("docs").over(Window.partitionBy("h")).alias("n"))
    shared = counted.where("n > 1").select("lot", "h", (F.col("n") > MOST_DOCS).alias("hot"))
    suffixes = lots.groupBy("lot").cogroup(shared.groupBy("lot")).applyInArrow(suffixes_of_lot, SUFFIX)
    groups = suffixes.repartition("key").sortWithinPartitions("key", "doc_id")
    return groups.mapInArrow(removed_of_groups, "lot bigint, row int, pos int, n int")


def kept_words(table: pa.Table, removed: pa.Table) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Place in ``table``, words and which of them stay, for every document of a lot."""
    spans = defaultdict(list)
    for row, pos, n in zip(*(removed[c].to_pylist() for c in ("row", "pos", "n")), strict=True):
        spans[row].append((pos, n))
    docs = Lot(table)
    for row, words in enumerate(docs.words):
        stay = np.ones(len(words), dtype=bool)
        for pos, n in spans[row]:
            stay[pos : pos + n] = False
        yield docs.order[row], words, stay


def deduplicated(docs: DataFrame) -> DataFrame:
    """``rest`` (the other columns), ``text`` (the kept words), ``n_words`` and ``n_removed``.

    A text that loses nothing stays as it is; the kept words of another are joined by one space.
    """
    lots = in_lots(docs)
    kind = f"rest {lots.schema['rest'].dataType.simpleString()}, text string, n_words bigint, n_removed bigint, kept_sha256 string"

    def finish(table: pa.Table, removed: pa.Table) -> pa.Table:
        rows = []
        for place, words, stay in kept_words(table, removed):
            kept = b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s])
            n = int(stay.sum())
            text = table["text"][place].as_py() if n == len(words) else kept.decode("utf-8", "surrogatepass")
            rows.append((place, text, len(words), len(words) - n, hashlib.sha256(kept).hexdigest()))
        places, *columns = zip(*rows, strict=True) if rows else ([],) * 5
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        names = ["rest", "text", "n_words", "n_removed", "kept_sha256"]
        return pa.table([table["rest"].take(pa.array(places, pa.int64())), *arrays], names)

    return lots.groupBy("lot").cogroup(removed_words(lots).groupBy("lot")).applyInArrow(finish, kind)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256``."""
    return deduplicated(docs.select("doc_id", "text")).select("rest.doc_id", "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the words that repeat earlier documents; ``n_chars`` follows, if it is there."""
    own = deduplicated(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("rest.n_chars") if "n_chars" in docs.columns else None)
    changed = {"text": F.col("text"), "n_chars": n_chars}
    return own.select(*((changed[c] if c in changed else F.col("rest")[c]).alias(c) for c in docs.columns))


WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
SQL = f"""
WITH d AS (
  SELECT doc_id, {WORDS} AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d
), windows AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS first FROM starts
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM windows, range({WINDOW}) v(k) WHERE first < doc_id
), kept AS (
  SELECT w.doc_id, w.i, w.word FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d) w
  ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i
), texts AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM kept GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(t.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t.text, '')) AS kept_sha256
FROM d LEFT JOIN texts t USING (doc_id)
"""
