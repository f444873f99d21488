"""Chat formatting by columnar byte assembly.

Turns are sorted by conversation, so a task sees conversations one after the other. For a slice of
turns the lengths of all headers, contents and endings give the place of every segment; one buffer is
allocated, the segments are scattered into it with numpy, and the buffer becomes an Arrow column of
formatted texts without another copy. A row of the result is a conversation, or a part of it where it
is longer than a slice, with the byte spans of what the loss is taken on (the assistants' texts).

What looks like a control string inside a text gets a backslash after its first character, one more than
it has, and reading takes it away again. A conversation of any length runs through in slices;
its digest, by its nature one sequence, is kept up to date part by part.

Defined results: null texts and null roles are empty; a null ``conv_id`` is a conversation of its own;
turns with equal numbers stand by role, then text; repeated rows are turns of their own; an empty
table gives no rows. Roles other than user and assistant are named in the header, percent-escaped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of texts formatted at a time; a longer text is formatted alone.
SLICE_BYTES = 4 << 20
LOSS_ROLE = "assistant"
HEADERS = {"user": "<s>[INST]\n", LOSS_ROLE: "<s>[/INST]\n"}
ENDING = "\n</s>\n"
#: A control string, or one with backslashes after its first character.
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE ))"
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]|ROLE ))")
TURN = re.compile(r"<s>\[(?:(INST)|(/INST)|ROLE ([^\]]*))\]\n(.*?)\n</s>\n", re.DOTALL)
FORMATTED = "conv_id bigint, part bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"


def header(role: str) -> str:
    return HEADERS.get(role, f"<s>[ROLE {quote(role, safe='')}]\n")


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def scattered(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies the segments of ``source`` at ``start`` to the places ``to`` of ``out``."""
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + inside] = source[np.repeat(start, length) + inside]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and lengths of a text column."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


def assembled(conv: pa.Array, roles: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The formatted conversations of a slice of turns, without their part numbers."""
    contents = pc.replace_substring_regex(texts, CONTROL, r"\1\\\2\3")
    names = roles.dictionary_encode()
    kinds = names.indices.to_numpy()
    content, content_at, content_len = buffers(contents)
    heads, heads_at, heads_len = buffers(pa.array([header(r) for r in names.dictionary.to_pylist()], pa.string()))
    head_at, head_len = heads_at[kinds], heads_len[kinds]
    ending = np.frombuffer(ENDING.encode(), dtype=np.uint8)
    ending_len = np.full(len(texts), len(ending))
    ends = np.cumsum(head_len + content_len + ending_len)
    starts = ends - head_len - content_len - ending_len
    out = np.empty(ends[-1], dtype=np.uint8)
    scattered(out, starts, heads, head_at, head_len)
    scattered(out, starts + head_len, content, content_at, content_len)
    scattered(out, ends - ending_len, ending, np.zeros_like(starts), ending_len)
    ids = conv.fill_null(0).to_numpy()
    null = conv.is_null().to_numpy(zero_copy_only=False)
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    first = np.flatnonzero(new)
    offsets = np.append(starts[first], ends[-1]).astype(np.int64)
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    loss = np.flatnonzero(kinds == names.dictionary.index(LOSS_ROLE).as_py())
    owner = np.cumsum(new)[loss] - 1
    cut = pa.array(np.searchsorted(owner, np.arange(len(first) + 1)), pa.int32())
    begin = (starts + head_len)[loss] - offsets[owner]
    spans = [pa.ListArray.from_arrays(cut, pa.array(b, pa.int64())) for b in (begin, begin + content_len[loss])]
    columns = [conv.take(pa.array(first)), formatted.cast(pa.string()), *spans]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "loss_starts", "loss_ends"])


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of bounded text."""
    upto = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def format_conversations(conversations: DataFrame) -> DataFrame:
    """A row per conversation, or part of a long one, in order within the partition."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), text("role"), text("text"), "turn")
    order = ["conv_id", "turn", "role", "text"]
    turns = turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            for piece in slices(batch):
                made = assembled(*piece.columns)
                parts = np.zeros(made.num_rows, dtype=np.int64)
                ids = made.column(0)
                if ids[0].as_py() == last:
                    parts[0] = part + 1
                last, part = ids[len(ids) - 1].as_py(), int(parts[-1])
                yield pa.RecordBatch.from_arrays([ids, pa.array(parts), *made.columns[1:]], names)

    names = [c.split()[0] for c in FORMATTED.split(", ")]
    return turns.mapInArrow(build, FORMATTED)


class Reader:
    """What is read back of one conversation, part by part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        self.chars += len(formatted)
        at = 0
        for turn in TURN.finditer(formatted):
            if turn.start() != at:
                raise ValueError(f"conversation {self.conv_id} cannot be read back")
            at = turn.end()
            role = "user" if turn[1] else LOSS_ROLE if turn[2] else unquote(turn[3])
            self.turns.update(f"{role}\n{unescaped(turn[4])}\n".encode())
            self.n_turns += 1
        if at != len(formatted):
            raise ValueError(f"conversation {self.conv_id} cannot be read back")
        data = formatted.encode()
        for start, end in zip(starts, ends, strict=True):
            text = unescaped(data[start:end].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """A row per conversation of ``format_conversations``, from its output alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done = None, []
        for batch in batches:
            for conv_id, _, text, starts, ends in zip(*batch.columns, strict=True):
                if own is None or own.conv_id != conv_id.as_py():
                    if own is not None:
                        done.append(own.row())
                    own = Reader(conv_id.as_py())
                own.add(text.as_py(), starts.as_py(), ends.as_py())
            if done:
                yield rows(done)
                done = []
        if own is not None:
            yield rows([own.row()])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.mapInArrow(read, kind)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), f AS (
  SELECT *, length(CASE role WHEN 'user' THEN '<s>[INST]' WHEN 'assistant' THEN '<s>[/INST]' ELSE '<s>[ROLE ' || role || ']' END)
         + 7 + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE ))', '\1\\\2\3', 'g')) AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
