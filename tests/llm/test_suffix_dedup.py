"""Suffix order and byte repeats against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallygauge.llm import induced, suffix_dedup


def in_order(text, cap):
    own = bytes(text)
    order = sorted(range(len(own)), key=lambda i: own[i : i + cap])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < cap and a + n < len(own) and b + n < len(own) and own[a + n] == own[b + n]:
            n += 1
        common.append(n)
    return [own[i : i + cap] for i in order], common


def odd_text(rng):
    letters = rng.choice([1, 2, 4, 20])
    text = [rng.randrange(2, letters + 2) for _ in range(rng.randrange(1, 300))]
    for _ in range(rng.randrange(6)):
        start = rng.randrange(len(text))
        text += text[start : start + rng.randrange(200)] + [1] * rng.randrange(2)
    if rng.random() < 0.3:
        text = (text[: rng.randrange(1, 20)] * 60)[:400]
    return [*text, 0]


@pytest.mark.parametrize("memory", [3, 20, 300, 100_000])
def test_suffixes_are_in_order(tmp_path, monkeypatch, memory):
    monkeypatch.setattr(induced, "BLOCK", 7 if memory == 20 else 1 << 16)
    rng = random.Random(memory)
    for i in range(30):
        text, cap = odd_text(rng), rng.choice([9, 40, 10_000])
        folder = tmp_path / str(i)
        folder.mkdir()
        blocks = list(induced.decreasing(np.array(text, np.uint8), cap, memory, folder))
        positions = [p for block, _ in blocks for p in block.tolist()]
        common = [n for _, block in blocks for n in block.tolist()]
        want, shared = in_order(text, cap)
        assert sorted(positions) == list(range(len(text)))
        assert [bytes(text)[p : p + cap] for p in positions] == want[::-1]
        assert common[1:] == shared[:0:-1]


def test_waiting_items_go_to_disk(tmp_path):
    waiting = induced.Waiting(tmp_path / "queue", 10, 1)
    for i in range(50):
        waiting.push(i % 3, np.array([i]), np.array([i % 7]))
        assert waiting.held <= 10
    assert (tmp_path / "queue").exists()
    for symbol in range(3):
        assert waiting.next_symbol() == symbol
        got = [p for positions, _ in waiting.pop(symbol) for p in positions.tolist()]
        assert got == list(range(symbol, 50, 3))
    assert waiting.next_symbol() is None


def plain_repeats(texts, window):
    texts = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for text in texts:
        gone = np.zeros(len(text) + 2, bool)
        for i in range(len(text) - window + 1):
            if counts[text[i : i + window]] > 1:
                gone[i + 1 : i + 1 + window] = True
        kept = bytes(b for b, g in zip(text, gone[1:-1].tolist(), strict=True) if not g)
        yield len(text), len(text) - len(kept), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()


SETTINGS = [{}, {"shard_bytes": 300, "memory": 50, "lot_bytes": 500}, {"most_places": 2, "lot_bytes": 2_000}]


@pytest.mark.parametrize("settings", SETTINGS)
@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_repeats_go(request, name, settings):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, *own) for (i, _), own in zip(rows, plain_repeats([t for _, t in rows], 60), strict=True)]
    found = suffix_dedup.suffix_dedup(docs, window=60, gram=16, **settings)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_repeats_within_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 9)
    rng = random.Random(2)
    words = [rng.choice(["an", "ab", "ba", "ü", "a" * 90]) for _ in range(1500)]
    texts = [" ".join(words), " ".join(words[200:260]), "a" * 1000, "ab" * 300, "".join(words[900:])]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    want = {i: own for i, own in enumerate(plain_repeats(texts, 100))}
    found = suffix_dedup.suffix_dedup(docs, window=100, gram=30, with_text=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_anchors_of_equal_windows_are_equal():
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 101) for _ in range(900))
    found = []
    for start in (b"", b"x" * 77):
        data, anchors = start + passage + start, {}
        for h, first, n in suffix_dedup.stretches(data, 400, 128):
            for key, at, size in zip(h.tolist(), first.tolist(), n.tolist(), strict=True):
                anchors |= {i - len(start): key for i in range(at, at + size)}
        found.append([anchors[i] for i in range(501)])
    assert found[0] == found[1]
