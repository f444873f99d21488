"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

Documents longer than a sequence are cut into full pieces, a shorter one first. Full pieces are
sequences already. The others are dealt evenly over groups of bounded size and each group is packed by
itself: a bin is filled greedily with the longest piece that still fits; then, as long as that
fills it better, its smallest piece is replaced by two unpacked pieces that fit the expanded gap
more tightly. Lengths are small whole numbers, so what is unpacked is a count per length and
finding a piece or a pair for a gap is a few operations on bit sets, however many pieces there are.

A group's loss is a few half-empty bins, so groups cost next to nothing against packing all together.
Rows are told apart by a number given when the pieces are written, so copies of one row
are dealt apart and a rerun of a task deals them the same way.

Defined results: a null or empty text is one piece with the end-of-document id alone; rows with
equal ``doc_id`` are packed each for itself; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.storage import documents_only, saved
from tallygauge.llm.tokens import default_path, encode_many

SEQUENCE = 1024
END_ID = 2
PIECES_PER_GROUP = 20_000
#: Characters tokenized at a time; a longer text is tokenized alone.
CHARS_AT_ONCE = 2_000_000
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """``doc_id`` and ``text`` values, so many texts at a time as hold ``CHARS_AT_ONCE``."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            own = text.as_py() or ""
            if texts and size + len(own) > CHARS_AT_ONCE:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key.as_py())
            texts.append(own)
            size += len(own)
    if texts:
        yield keys, texts


def cuts(n: int, sequence: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of ``n`` ids."""
    first = n % sequence or sequence
    return [(0, first), *((at, sequence) for at in range(first, n, sequence))]


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """A row per piece; its ``ids`` too, if asked for."""
    vocabulary = path or default_path()
    end = np.array([END_ID], dtype="<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches):
            rows, own = [], []
            for key, found in zip(keys, encode_many(texts, vocabulary), strict=True):
                ids = np.concatenate((found, end))
                for number, (start, length) in enumerate(cuts(len(ids), sequence)):
                    piece = ids[start : start + length]
                    rows.append((key, number, start, length, crc32(piece.tobytes())))
                    own.append(piece)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in own], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    kind = PIECE + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in kind.split(", ")]
    return documents_only(docs).mapInArrow(cut, kind)


class Unpacked:
    """How many pieces of each length are left, with bit sets for the lengths there are."""

    def __init__(self, lengths: np.ndarray, sequence: int):
        self.top = sequence
        self.left = np.bincount(lengths, minlength=sequence + 1).tolist()
        self.there = self.mirrored = 0
        for length in np.flatnonzero(self.left).tolist():
            self.there |= 1 << length
            self.mirrored |= 1 << (sequence - length)

    def take(self, length: int) -> None:
        self.left[length] -= 1
        if not self.left[length]:
            self.there &= ~(1 << length)
            self.mirrored &= ~(1 << (self.top - length))

    def put(self, length: int) -> None:
        self.left[length] += 1
        self.there |= 1 << length
        self.mirrored |= 1 << (self.top - length)

    def longest(self, gap: int) -> int:
        """The longest length up to ``gap``, or 0."""
        return max(0, (self.there & ((1 << (gap + 1)) - 1)).bit_length() - 1)

    def pair(self, gap: int, least: int) -> tuple[int, int] | None:
        """Two lengths with the largest sum from ``least`` to ``gap``."""
        for total in range(gap, least - 1, -1):
            found = self.there & (self.mirrored >> (self.top - total))
            if total % 2 == 0 and found >> (total // 2) & 1 and self.left[total // 2] < 2:
                found &= ~(1 << (total // 2))
            if found:
                a = found.bit_length() - 1
                return a, total - a
        return None


def best_two_fit(lengths: np.ndarray, sequence: int) -> list[list[int]]:
    """The lengths in each bin."""
    unpacked, bins = Unpacked(lengths, sequence), []
    while unpacked.there:
        own, gap = [], sequence
        while length := unpacked.longest(gap):
            unpacked.take(length)
            own.append(length)
            gap -= length
        # The piece that opens a bin stays: it is the longest there is, and would need a bin again.
        while gap and len(own) > 1:
            smallest = own[-1]
            better = unpacked.pair(gap + smallest, smallest + 1)
            if better is None:
                break
            unpacked.put(own.pop())
            for length in better:
                unpacked.take(length)
                own.append(length)
            own.sort(reverse=True)
            gap = sequence - sum(own)
        bins.append(own)
    return bins


def placed(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its place there."""
    bins = best_two_fit(lengths, sequence)
    bin_of = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    packed = np.array([n for b in bins for n in b], dtype=np.int64)
    place = np.concatenate([np.cumsum([0, *b[:-1]]) for b in bins]) if bins else packed
    # Pieces of one length are alike: the k-th packed one is the k-th of the input.
    order, slots = np.argsort(lengths, kind="stable"), np.argsort(packed, kind="stable")
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number[order], offset[order] = bin_of[slots], place[slots]
    return number, offset


def packed(parts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    parts = saved(parts.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = parts.where(F.col("length") == sequence)
    rest = parts.where(F.col("length") != sequence)
    groups = max(1, -(-rest.count() // PIECES_PER_GROUP))
    kind = ", ".join(f"{c} {t}" for c, t in rest.drop("uid").dtypes) + ", sequence_id bigint, offset bigint"

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("uid")
        number, offset = placed(rows["length"].to_numpy(), sequence)
        number += rows["lot"][0].as_py() << 32
        own = rows.drop_columns(["uid", "lot"])
        return own.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    lot = F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("lot")
    shared = rest.select("*", lot).groupBy("lot").applyInArrow(pack, kind)
    alone = full.withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("bigint")})
    return shared.unionByName(alone.select(shared.columns))


def pack_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    return packed(pieces(docs, path, with_ids=with_ids))
