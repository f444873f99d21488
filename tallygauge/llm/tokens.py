"""Token ids of the public byte-level BPE vocabulary, at the speed of its distinct words.

The vocabulary cuts a text into words by a fixed pattern and merges bytes within each word, so the
ids of a text are those of its words in a row. Words are cut here with numpy over code point classes,
equal words of many texts are found together, and each distinct word is encoded once per worker (a
bounded cache). A text with a code point that Python's Unicode tables do not know, and the library's may, is
encoded by the ``tokenizers`` library. ``tests/llm`` compares all ids with those of that library.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: The same vocabulary as ``byte_bpe_50k.json``, as ranks of byte strings.
VOCABULARY = "byte_bpe_50k.tiktoken"
WORDS_KEPT = 400_000
#: Classes of code points in the vocabulary's pattern, its endings and its special text.
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8)
    table[list(WHITE)] = SPACE
    return table


@lru_cache(maxsize=1)
def unassigned() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), dtype=bool)


def word_starts(text: str, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of the pattern begin in texts that stand one after the other.

    ``codes`` are the code points of ``text``; ``begins`` is where each text begins, in order.
    """
    kind = class_table()[codes]
    start = np.empty(len(codes), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[begins] = True
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], len(codes))
    edge = np.zeros(len(codes) + 1, dtype=bool)
    edge[begins] = edge[len(codes)] = True
    # The last character of white space before a word is on its own; a plain space joins the word.
    white = (kind[runs] == SPACE) & ~edge[ends]
    last = ends[white] - 1
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    # An apostrophe that begins a word takes one of the endings with it.
    for at in np.flatnonzero((codes == 0x27) & start).tolist():
        for ending in ENDINGS:
            after = at + 1 + len(ending)
            if text.startswith(ending, at + 1) and not edge[at + 1 : after].any():
                start[at + 1 : after] = False
                start[after : after + 1] = True
                break
    return np.flatnonzero(start)


class Words(dict):
    """Ids by word, as bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = array("I", self.encoding.encode_ordinary(word)).tobytes()
        return found


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


@lru_cache(maxsize=2)
def library_of(path: str) -> Tokenizer:
    """The same vocabulary in the library's own format, which lies beside the ranks."""
    return Tokenizer.from_file(str(Path(path).with_suffix(".json")))


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def same_words(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct word, and for every word which of them it is.

    Words are grouped by a hash; then every character is compared with its group's first word.
    """
    power = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * power[:-1], out=sums[1:])
    hashes = (sums[starts + lengths] - sums[starts]) * power[len(codes) - starts]
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    shift = starts[first][which] - starts
    own = np.arange(len(codes)) + np.repeat(shift, lengths)
    if not (np.array_equal(lengths[first][which], lengths) and np.array_equal(codes[own], codes)):
        return np.arange(len(starts)), np.arange(len(starts))
    return first, which


@lru_cache(maxsize=4)
def all_powers(size: int) -> np.ndarray:
    factors = np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def powers(n: int) -> np.ndarray:
    return all_powers(1 << (n - 1).bit_length())[:n]


def encode_many(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text, without special tokens added."""
    if any(SPECIAL in t for t in texts):
        return [encode(t, path) for t in texts]
    text = "".join(texts)
    if not text:
        return [np.empty(0, dtype="<u4") for _ in texts]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    begins = np.cumsum([0, *map(len, texts)])
    unknown = np.flatnonzero(unassigned()[codes])
    if len(unknown):
        strange = set((np.searchsorted(begins, unknown, side="right") - 1).tolist())
        ids = encode_many(["" if i in strange else t for i, t in enumerate(texts)], path)
        for i in strange:
            ids[i] = np.array(library_of(path).encode(texts[i], add_special_tokens=False).ids, dtype="<u4")
        return ids
    starts = word_starts(text, codes, begins[:-1][begins[:-1] < len(codes)])
    lengths = np.diff(np.append(starts, len(codes)))
    first, which = same_words(codes, starts, lengths)
    words = words_of(path)
    cuts = zip(starts[first].tolist(), (starts + lengths)[first].tolist(), strict=True)
    found = [words[text[a:b]] for a, b in cuts]
    ids = np.frombuffer(b"".join(found), dtype="<u4")
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
    place = np.cumsum(sizes) - sizes
    each = sizes[which]
    offsets = np.concatenate(([0], np.cumsum(each)))
    flat = ids[np.arange(offsets[-1]) + np.repeat(place[which] - offsets[:-1], each)]
    cut = offsets[np.searchsorted(starts, begins)]
    return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def encode(text: str, path: str) -> np.ndarray:
    """The ids of a text, without special tokens added; the special text in it is one id."""
    special = np.array([SPECIAL_ID], dtype="<u4")
    parts = [special]
    for piece in text.split(SPECIAL):
        parts += [special, *encode_many([piece], path)]
    return np.concatenate(parts[2:])
