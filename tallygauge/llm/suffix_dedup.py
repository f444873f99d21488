"""Removal of repeated byte strings with suffix arrays sorted on disk.

A window is ``WINDOW`` bytes of one text; every byte of a window that also stands anywhere else is removed.

1. *Anchors.* A window's anchor is the gram of ``GRAM`` bytes in it with the lowest hash, so equal windows have equal
   anchors. Consecutive windows with one anchor are a stretch. Lots of documents send the hash of each anchor they have to a count.
2. *Stretches* whose anchor stands elsewhere too leave their lot, once for all copies in it, to the task of the anchor. Stretches that are equal as a
   whole (128-bit digests) are repeated as a whole. Different ones with the same anchor are sorted, one of each kind.
3. *Shards.* What a task has to sort, about ``SHARD_BYTES``, is one text of all its stretches, each ended by a sign below all bytes; its
   suffixes are put in order with their common prefixes by induced sorting on disk (``induced``). A window is repeated where the common prefix
   with a neighbour reaches ``WINDOW`` bytes. No such window reaches over the end of a stretch.
4. An anchor that stands in more than ``MOST_PLACES`` places is too much for one task. Its windows leave one by one, by digests of the
   whole window, and go to a task each.
5. Lots take back what is removed. What leaves a lot is one row for all equal stretches or windows in it, so a passage of every
   document is a row per lot, and no more than one row of a kind is held.

Defined results: a null text is empty; texts of less than ``WINDOW`` bytes stay; repeated rows repeat each other, also without ``doc_id``; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.induced import decreasing, scratch_folder
from tallygauge.llm.storage import documents_only

WINDOW = 400
GRAM = 128
LOT_BYTES = 8 << 20
SHARD_BYTES = 6 << 20
MOST_PLACES = 1 << 16
#: Items a shard's sort holds in memory.
SORTED_IN_MEMORY = 1 << 22
#: Bytes of a text looked at together, and the bits that number them.
PLACE_BITS = 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place."""
    n = len(data)
    size = 1 << n.bit_length()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers(BASE, size)[:n], out=sums[1:])
    x = (sums[gram:] - sums[:-gram]) * powers(INVERSE, size)[: n - gram + 1]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowest(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values."""
    n = len(values)
    blocks = -(-n // size)
    filled = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    filled[:n] = values
    table = filled.reshape(blocks, size)
    upto = np.minimum.accumulate(table, axis=1).ravel()
    since = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[: n - size + 1], upto[size - 1 : n])


def stretches(data: bytes, window: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor hash, first window and number of windows of the stretches of a text, some at a time."""
    step = (1 << PLACE_BITS) - window
    for at in range(0, len(data) - window + 1, step):
        own = np.frombuffer(data, np.uint8, min(step + window - 1, len(data) - at), at).astype(np.uint64)
        hashes = gram_hashes(own, gram)
        # The place in the low bits: of equal hashes the first one is the lowest.
        place = np.uint64((1 << PLACE_BITS) - 1)
        keys = hashes & ~place | np.arange(len(hashes), dtype=np.uint64)
        anchor = (lowest(keys, window - gram + 1) & place).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        yield hashes[anchor[first]].view(np.int64), first + at, np.diff(np.append(first, len(anchor)))


class Lot:
    """The documents of a lot in an order that does not depend on how they came."""

    def __init__(self, table: pa.Table):
        ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
        own = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, own[i]))
        self.order, self.ids, self.texts = order, [ids[i] for i in order], [own[i] for i in order]


def rows_of(kind: str, columns: list) -> pa.Table:
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [c.split() for c in kind.split(", ")]
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


ANCHOR = "lot bigint, h bigint, times int"
STRETCH = "lot bigint, h bigint, d binary, n int, places binary, text binary"
#: What goes from a lot: row, first byte and the byte after the last, of any number of parts.
SPAN = "lot bigint, parts binary"


def in_lots(docs: DataFrame, lot_bytes: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """The documents with their lot, and the number of shards."""
    own = documents_only(docs)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // lot_bytes + 1))
    return own.select(lot.cast("bigint").alias("lot"), "doc_id", "text"), size // shard_bytes + 1


def shared_anchors(lots: DataFrame, window: int, gram: int, most_places: int) -> DataFrame:
    """``lot``, ``h`` and ``many``: the anchors of each lot that stand in another place as well, and in how many."""

    def anchors(table: pa.Table) -> pa.Table:
        found = [h for text in Lot(table).texts for h, _, _ in stretches(text, window, gram)]
        every, times = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
        return rows_of(ANCHOR, [np.full(len(every), table["lot"][0].as_py()), every, times])

    own = lots.groupBy("lot").applyInArrow(anchors, ANCHOR)
    # Lots are added up before the shuffle; the join back splits an anchor that very many lots have.
    often = own.groupBy("h").agg(F.sum("times").alias("n")).where("n > 1")
    return own.select("lot", "h").join(often, "h").select("lot", "h", (F.col("n") > most_places).alias("many"))


def leaving(lots: DataFrame, anchors: DataFrame, window: int, gram: int) -> DataFrame:
    """The different stretches of each lot with a shared anchor, and the places (row, first window) of each.

    Windows that leave one by one have no text: equal digests say all there is to say of them.
    """

    def leave(table: pa.Table, shared: pa.Table) -> pa.Table:
        shared = shared.sort_by("h")
        known, many = shared["h"].to_numpy(), shared["many"].to_numpy()
        found: dict[tuple[int, bytes], list] = {}
        if table.num_rows and len(known):
            for row, text in enumerate(Lot(table).texts):
                for h, first, n in stretches(text, window, gram):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    own = np.flatnonzero(known[at] == h)
                    columns = (h[own].tolist(), first[own].tolist(), n[own].tolist(), many[at[own]].tolist())
                    for key, start, size, one_by_one in zip(*columns, strict=True):
                        if one_by_one:
                            for i in range(start, start + size):
                                digest = digest_of(text[i : i + window])
                                key = int.from_bytes(digest[:8], "little", signed=True)
                                found.setdefault((key, digest), [1, None, []])[2].append((row, i))
                        else:
                            stretch = text[start : start + size + window - 1]
                            found.setdefault((key, digest_of(stretch)), [size, stretch, []])[2].append((row, start))
        lot = table["lot"][0].as_py() if table.num_rows else None
        columns = [
            [lot] * len(found),
            [h for h, _ in found],
            [d for _, d in found],
            [size for size, _, _ in found.values()],
            [np.array(places, np.int64).tobytes() for _, _, places in found.values()],
            [own for _, own, _ in found.values()],
        ]
        return rows_of(STRETCH, columns)

    return lots.groupBy("lot").cogroup(anchors.groupBy("lot")).applyInArrow(leave, STRETCH)


def digest_of(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


#: A place as written: row and first window.
PLACE_BYTES = 16


def places_of(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, np.int64).reshape(-1, 2)


def span_batches(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from rows_of(SPAN, [*zip(*rows, strict=True)]).combine_chunks().to_batches()


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [*zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


class Shard:
    """Stretches written into one text on disk, to find the windows that stand in it more than once."""

    def __init__(self, folder: Path, window: int, memory: int):
        self.folder, self.window, self.memory = folder, window, memory
        self.sizes: list[int] = []
        self.out = (folder / "shard").open("wb", buffering=1 << 20)

    def add(self, text: bytes) -> None:
        # Bytes of UTF-8 stay below 0xF6, so two signs are free below them and the highest one above.
        self.sizes.append(len(text))
        self.out.write((np.frombuffer(text, np.uint8) + np.uint8(2)).tobytes())
        self.out.write(b"\x01")

    def repeated(self) -> Iterator[list[tuple[int, int]]]:
        """For each stretch the runs of windows that also stand elsewhere in the shard."""
        self.out.write(b"\x00")
        self.out.close()
        if not self.sizes:
            return
        shard = np.memmap(self.folder / "shard", np.uint8, "r")
        again = np.memmap(self.folder / "again", np.uint8, "w+", shape=shard.shape)
        before = None
        for positions, common in decreasing(shard, self.window, self.memory, self.folder):
            long = common >= self.window
            again[positions[long]] = 1
            again[positions[:-1][long[1:]]] = 1
            if long[0]:
                again[before] = 1
            before = positions[-1]
        at = 0
        for size in self.sizes:
            # What begins later goes on over the sign at the end and is no window.
            yield runs(np.asarray(again[at : at + size - self.window + 1]))
            at += size + 1


NAMES = [c.split()[0] for c in STRETCH.split(", ")]


def spans_of_task(batches: Iterator[pa.RecordBatch], window: int, memory: int) -> Iterator[pa.RecordBatch]:
    """The repeated parts of a task's stretches, which come in the order of anchor and digest: at most one row for each."""
    rows, owners = [], []

    def whole(lot: int, n: int, places: bytes) -> None:
        own = places_of(places)
        rows.append((lot, np.column_stack((own, own[:, 1] + n + window - 1)).tobytes()))

    with scratch_folder() as name:
        shard = Shard(Path(name), window, memory)

        def sort(lot: int, places: bytes, text: bytes) -> None:
            owners.append((lot, *places_of(places)[0].tolist()))
            shard.add(text)

        anchor = digest = None
        # The first row of a kind until there is a second, and the first kind of an anchor likewise.
        first = single = None
        for batch in batches:
            for lot, h, d, n, places, text in zip(*(batch[c].to_pylist() for c in NAMES), strict=True):
                if (h, d) == (anchor, digest):
                    if first is not None:
                        whole(*first)
                        first = None
                    whole(lot, n, places)
                    continue
                first = lot, n, places
                if len(places) > PLACE_BYTES:
                    whole(*first)
                    first = None
                if h != anchor:
                    single = (lot, places, text) if text is not None else None
                elif text is not None:
                    if single is not None:
                        sort(*single)
                        single = None
                    sort(lot, places, text)
                anchor, digest = h, d
            if len(rows) >= 10_000:
                yield from span_batches(rows)
                rows.clear()
        for (lot, row, at), found in zip(owners, shard.repeated(), strict=True):
            if found:
                rows.append((lot, np.array([(row, at + s, at + e + window - 1) for s, e in found], np.int64).tobytes()))
            if len(rows) >= 10_000:
                yield from span_batches(rows)
                rows.clear()
    yield from span_batches(rows)


def removed_spans(lots: DataFrame, shards: int, window: int, gram: int, most_places: int, memory: int) -> DataFrame:
    """``lot`` and ``parts``: the bytes that go."""
    found = leaving(lots, shared_anchors(lots, window, gram, most_places), window, gram)
    dealt = found.repartition(shards, "h").sortWithinPartitions("h", "d", "lot")
    return dealt.mapInArrow(lambda batches: spans_of_task(batches, window, memory), SPAN)


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def suffix_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    with_text: bool = False,
    lot_bytes: int = LOT_BYTES,
    shard_bytes: int = SHARD_BYTES,
    most_places: int = MOST_PLACES,
    memory: int = SORTED_IN_MEMORY,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``; with ``with_text`` also ``kept``, the bytes that stay."""
    lots, shards = in_lots(docs, lot_bytes, shard_bytes)
    gone = removed_spans(lots, shards, window, gram, most_places, memory)

    def finish(table: pa.Table, removed: pa.Table) -> pa.Table:
        by_row = defaultdict(list)
        parts = np.frombuffer(b"".join(removed["parts"].to_pylist()), np.int64).reshape(-1, 3)
        for row, first, after in np.unique(parts, axis=0).tolist():
            by_row[row].append((first, after))
        rows = []
        lot = Lot(table)
        for row, (doc_id, text) in enumerate(zip(lot.ids, lot.texts, strict=True)):
            kept, at, n_spans = [], 0, 0
            for first, after in by_row[row]:
                # A span that begins where the one before ends goes on with it.
                if first > at or not n_spans:
                    n_spans += 1
                    kept.append(text[at:first])
                at = max(at, after)
            kept = b"".join([*kept, text[at:]])
            rows.append((doc_id, len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = [*zip(*rows, strict=True)] if rows else [[]] * 6
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [c.split()[0] for c in KEPT.split(", ")] + ["kept"]
        made = pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        return made if with_text else made.drop_columns(["kept"])

    return lots.groupBy("lot").cogroup(gone.groupBy("lot")).applyInArrow(finish, KEPT + (", kept binary" if with_text else ""))

