"""Alignment of two tokenizers' tokens: divide and conquer at shared cuts.

A text with a space before it is encoded by a byte-level BPE (A) and by a piece BPE (B). A token ends at a byte; where a
token of both ends there is a shared cut. The search for cuts is recursive: in an interval of tokens the end in the middle of
A's is looked up among B's by bisection; if B has none there, the ends around it are, nearest first, until one
is shared. The interval is split there and both halves are searched, without the ends that were looked
up already, so each is looked up once. An interval without a cut is a leaf, and the leaves are the groups. The tokens that
end at a cut are linked.

Texts are encoded word by word, a word with the space before it: neither vocabulary has a token that goes on over a space after
other characters (``joins_words`` tells, and a vocabulary that has one is refused). So the end of a word is always a shared cut, where
texts are split first. The interval of each distinct word is searched once per worker (a bounded cache), those of all new words together;
a text's groups and links are those of its words, one after the other, in stretches of at most ``WORDS_AT_ONCE`` words.

Links are counted over all documents. Rows are written once, in lots of about ``LOT_LINKS`` links; a lot sends each of its
pairs once to the count and gets the count back, so a pair that stands in every document is one row per lot.

Defined results: a text that is null or empty, or that one of the tokenizers changes (its tokens' bytes are not the text's),
has no tokens: zeros, and an empty digest. Rows without ``doc_id`` and repeated rows count like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallygauge.llm.packing import chunks
from tallygauge.llm.storage import documents_only, saved

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
WORDS_KEPT = 300_000
#: Of groups and links of the kept words.
BYTES_KEPT = 64 << 20
WORDS_AT_ONCE = 100_000
#: Different links of the documents of a lot, at least.
LOT_LINKS = 1 << 20
#: A space after white space belongs to the word before.
SPACES = re.compile(r"^ |\s ")


def shared_cuts(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> np.ndarray:
    """For every A token the B token that ends with it, or -1.

    ``a`` and ``b`` are ends, increasing over several texts; ``a_last`` and ``b_last`` are the last tokens of
    the texts. The intervals of one depth of the recursion are searched together.
    """
    partner = np.full(len(a), -1)
    partner[a_last] = b_last
    # An interval: A's ends from low to high that were not looked up yet, B's from first to last, and
    # the ends to look up next on both sides of the middle.
    low, high = np.append(0, a_last[:-1] + 1), a_last
    first, last = np.append(0, b_last[:-1] + 1), b_last
    before = (low + high) >> 1
    after = before + 1
    while True:
        keep = (low < high) & (first < last) & ((before >= low) | (after < high))
        if not keep.any():
            return partner
        low, high, first, last, before, after = (x[keep] for x in (low, high, first, last, before, after))
        found, cut = np.zeros(len(low), bool), np.zeros(len(low), np.int64)
        ends = []
        for at, inside in ((before, before >= low), (after, after < high)):
            end = a[np.clip(at, low, high - 1)]
            place = np.minimum(np.searchsorted(b, end), len(b) - 1)
            hit = inside & ~found & (place >= first) & (place < last) & (b[place] == end)
            partner[at[hit]] = place[hit]
            cut[hit] = place[hit]
            found |= hit
            ends.append(hit)
        missed = ~found
        again = (low, high, first, last, before - 1, after + 1)
        left = np.stack((low, before, first, cut))[:, found]
        right = np.stack((after + ends[1], high, cut + 1, last))[:, found]
        halves = np.stack((left, right), axis=2).reshape(4, -1)
        middle = (halves[0] + halves[1]) >> 1
        fresh = (*halves, middle, middle + 1)
        low, high, first, last, before, after = (np.concatenate((x[missed], y)) for x, y in zip(again, fresh, strict=True))


def byte_symbols() -> dict[str, int]:
    """The byte of each symbol of a byte-level vocabulary: visible ones stand for themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def joins_words(pieces: list[bytes]) -> bool:
    """Whether a token has a space after another character than white space."""
    return any(re.search(r"\S ", p.decode("utf-8", "replace")) for p in pieces)


class Words:
    """By word: the number of tokens of both sides (A's in the high half), the groups, and the links.

    A word that one of the tokenizers changes has None. Words are written without the space before them.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str):
        # A task has a core; without this, each would deal its words to threads for all cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        symbols, size = byte_symbols(), self.a.get_vocab_size()
        self.a_bytes = [bytes(symbols.get(c, 0x20) for c in self.a.id_to_token(i) or "") for i in range(size)]
        own = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(own)
        ]
        # A byte-level vocabulary with all bytes keeps every text; the other one is compared word by word.
        if self.a.normalizer is not None or not {bytes([b]) for b in range(256)} <= {*self.a_bytes}:
            raise ValueError("the first vocabulary does not keep the bytes of texts")
        if joins_words(self.a_bytes) or joins_words(self.b_bytes):
            raise ValueError("a vocabulary with tokens over several words")
        if max(size, len(own)) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.a_lengths, self.b_lengths = (np.array([*map(len, t)]) for t in (self.a_bytes, self.b_bytes))
        # Ids as text with what follows them: another id of the group, or its other side or the next group.
        self.a_texts = [b"%d%s" % (i, s) for i in range(size) for s in (b",", b"|")]
        self.b_texts = [b"%d%s" % (i, s) for i in range(len(own)) for s in (b",", b";")]
        self.texts = self.a_texts + self.b_texts
        self.text_sizes = np.array([*map(len, self.texts)])
        self.space = [self.b.piece_to_id(MARK)]
        self.cells: dict[str, tuple[int, bytes, bytes] | None] = {}
        self.held = 0

    def of(self, words: list[str]) -> list[tuple[int, bytes, bytes] | None]:
        distinct = set(words)
        new = distinct.difference(self.cells)
        if self.cells and (len(self.cells) + len(new) > WORDS_KEPT or self.held > BYTES_KEPT):
            self.cells.clear()
            self.held, new = 0, distinct
        if new:
            self.learn([*new])
        return list(map(self.cells.__getitem__, words))

    def learn(self, new: list[str]) -> None:
        self.cells.update(dict.fromkeys(new))
        # The second tokenizer puts the space before a text itself, but not before an empty one.
        b = [ids or self.space for ids in self.b.encode(new, num_threads=1)]
        spaced = [" " + w for w in new]
        b_text = b"".join(map(self.b_bytes.__getitem__, chain.from_iterable(b)))
        ends = np.cumsum(self.b_lengths[flat(b)])[upto(b) - 1].tolist()
        same = [b_text[i:j] == w.encode() for i, j, w in zip([0, *ends], ends, spaced)]
        new, spaced, b = ([*compress(x, same)] for x in (new, spaced, b))
        if not new:
            return
        a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        a_ids, b_ids, a_upto, b_upto = flat(a), flat(b), upto(a), upto(b)
        a_ends, b_ends = np.cumsum(self.a_lengths[a_ids]), np.cumsum(self.b_lengths[b_ids])
        partner = shared_cuts(a_ends, b_ends, a_upto - 1, b_upto - 1)
        text, sizes = group_text(a_ids, b_ids, partner, self)
        text_upto = np.cumsum(sizes)[a_upto + b_upto - 1].tolist()
        cut = partner >= 0
        links = (a_ids[cut] << 16 | b_ids[partner[cut]]).astype(np.uint32).tobytes()
        links_upto = (np.cumsum(cut)[a_upto - 1] * 4).tolist()
        counts = (np.diff(a_upto, prepend=0) << 32 | np.diff(b_upto, prepend=0)).tolist()
        i = j = 0
        for word, count, m, n in zip(new, counts, text_upto, links_upto, strict=True):
            self.cells[word] = count, text[i:m], links[j:n]
            i, j = m, n
        self.held += len(text) + len(links)


def flat(ids: list[list[int]]) -> np.ndarray:
    return np.array([*chain.from_iterable(ids)], np.int64)


def upto(ids: list[list[int]]) -> np.ndarray:
    """The number of ids up to the end of each list."""
    return np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))


@lru_cache(maxsize=2)
def words_of(byte_bpe: str, piece_bpe: str) -> Words:
    return Words(byte_bpe, piece_bpe)


def words_in(text: str) -> list[str]:
    """The words of a text, each without the space before it; put before each, those spaces make them a space and the text."""
    parts = text.split(" ")
    if not SPACES.search(text):
        return parts
    words, open_word = [], None
    for part in parts:
        open_word = part if open_word is None else open_word + " " + part
        if part and not part[-1].isspace():
            words.append(open_word)
            open_word = None
    return words if open_word is None else [*words, open_word]


def group_text(a: np.ndarray, b: np.ndarray, partner: np.ndarray, known: Words) -> tuple[bytes, np.ndarray]:
    """The ids of both sides in the order of the groups, each with the sign that follows it, and how long each is with its sign."""
    cut = partner >= 0
    group_of_a = np.cumsum(cut) - cut
    group_of_b = np.zeros(len(b), np.int64)
    ends = partner[cut]
    group_of_b[ends] = 1
    is_end = group_of_b.astype(bool)
    group_of_b = np.cumsum(group_of_b) - group_of_b
    a_sizes, b_sizes = np.cumsum(np.bincount(group_of_a)), np.append(0, np.cumsum(np.bincount(group_of_b)))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_sizes[group_of_a]] = a * 2 + cut
    order[np.arange(len(b)) + a_sizes[group_of_b]] = (b * 2 + is_end) + len(known.a_texts)
    return b"".join(map(known.texts.__getitem__, order.tolist())), known.text_sizes[order]


class Aligned:
    """What is known of a document while its stretches are aligned."""

    def __init__(self) -> None:
        self.whole = True
        self.tokens = 0
        self.digest = hashlib.sha256()
        self.links: list[bytes] = []
        self.sign = b""

    def add(self, cells: list[tuple[int, bytes, bytes]]) -> None:
        counts, groups, links = zip(*cells, strict=True)
        self.tokens += sum(counts)
        text = b"".join(groups)
        # The sign after the last group is written only when there is another one.
        self.digest.update(self.sign + text[:-1])
        self.sign = text[-1:]
        self.links.append(b"".join(links))

    def row(self) -> tuple[int, int, int, str, np.ndarray]:
        if not self.whole or not self.links:
            return 0, 0, 0, "", np.empty(0, np.uint32)
        links = np.frombuffer(b"".join(self.links), np.uint32)
        return self.tokens >> 32, self.tokens & 0xFFFFFFFF, len(links), self.digest.hexdigest(), links


def align_stretch(words: list[str], parts: list[tuple[Aligned, int]], known: Words) -> None:
    """Align words, which belong to some documents; ``parts`` has each with the number of its words."""
    found, at = known.of(words), 0
    for doc, n in parts:
        own = found[at : at + n]
        at += n
        doc.whole &= None not in own
        if doc.whole:
            doc.add(own)


def align_many(texts: list[str | None], known: Words) -> list[tuple[int, int, int, str, np.ndarray]]:
    """Per text: number of A tokens, of B tokens and of groups, the groups' digest, and the links as ``a << 16 | b``."""
    docs = [Aligned() for _ in texts]
    words, parts = [], []
    for doc, text in zip(docs, texts, strict=True):
        own = words_in(text) if text else []
        while own:
            some, own = own[: WORDS_AT_ONCE - len(words)], own[WORDS_AT_ONCE - len(words) :]
            words += some
            parts.append((doc, len(some)))
            if len(words) >= WORDS_AT_ONCE:
                align_stretch(words, parts, known)
                words, parts = [], []
    if words:
        align_stretch(words, parts, known)
    return [doc.row() for doc in docs]


ROW = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
ALIGNED = f"lot bigint, {ROW}, pairs binary, times binary"
TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def schema_of(kind: str) -> pa.Schema:
    return pa.schema([(name, TYPES[own]) for name, own in (c.split() for c in kind.split(", "))])


def aligned(docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None) -> DataFrame:
    """A row per document: what it has by itself, its lot, its different links and how often it has each."""
    paths = byte_bpe or public_tokenizers.path(BYTE_BPE), piece_bpe or public_tokenizers.path(PIECE_BPE)
    schema = schema_of(ALIGNED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words_of(*paths)
        lot, size = TaskContext.get().partitionId() << 32, 0
        for keys, texts in chunks(batches):
            out = []
            for doc_id, found in zip(keys, align_many(texts, known), strict=True):
                n_a, n_b, n_groups, digest, links = found
                pairs, times = np.unique(links, return_counts=True)
                out.append((lot, doc_id, n_a, n_b, n_groups, len(links), digest, pairs.tobytes(), times.astype(np.uint32).tobytes()))
                size += len(pairs)
                if size >= LOT_LINKS:
                    lot, size = lot + 1, 0
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return documents_only(docs).mapInArrow(rows, ALIGNED)


def numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The unsigned numbers in all cells of a binary column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32)


def pairs_of_lots(rows: DataFrame) -> DataFrame:
    """``lot``, ``pair`` and ``times``, the links of a lot; one that several tasks read is in several parts."""

    def part(lot: int, tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        pairs = np.concatenate([numbers(t["pairs"]) for t in tables])
        times = np.concatenate([numbers(t["times"]) for t in tables])
        every, at = np.unique(pairs, return_inverse=True)
        sums = np.bincount(at, times, len(every)).astype(np.int64)
        return pa.RecordBatch.from_arrays([np.full(len(every), lot), every.astype(np.int64), sums], ["lot", "pair", "times"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_lot, held = None, []
        for batch in batches:
            lots = batch["lot"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(lots)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if held and lots[start] != open_lot:
                    yield part(open_lot, held)
                    held = []
                open_lot = int(lots[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield part(open_lot, held)

    return rows.select("lot", "pairs", "times").mapInArrow(parts, "lot bigint, pair bigint, times bigint")


def link_counts(of_lots: DataFrame) -> DataFrame:
    """``pair``, its ``count`` over all documents and whether that is the ``best`` of its B token."""
    counts = of_lots.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFF))
    # A row per B token, 65,536 at most.
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    rows = saved(aligned(docs, byte_bpe, piece_bpe), "aligned")
    of_lots = saved(pairs_of_lots(rows), "links")
    counted = of_lots.select("lot", "pair").join(link_counts(of_lots), "pair")
    kind = f"{ROW}, n_best bigint, count_sum bigint"
    names = [c.split()[0] for c in ROW.split(", ")]

    def finish(lot: pa.Table, counts: pa.Table) -> pa.Table:
        found, at = np.unique(counts["pair"].to_numpy(), return_index=True)
        count, best = counts["count"].to_numpy()[at], counts["best"].to_numpy()[at]
        pairs, times = numbers(lot["pairs"]), numbers(lot["times"]).astype(np.int64)
        place = np.searchsorted(found, pairs)
        ends = np.cumsum([0, *(len(cell) // 4 for cell in lot["pairs"].to_pylist())])
        sums = [np.concatenate(([0], np.cumsum(v)))[ends] for v in (times * best[place], times * count[place])]
        columns = [lot[n] for n in names]
        return pa.table([*columns, *(pa.array(np.diff(s), pa.int64()) for s in sums)], [*names, "n_best", "count_sum"])

    return rows.groupBy("lot").cogroup(counted.groupBy("lot")).applyInArrow(finish, kind)
