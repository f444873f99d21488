"""Token alignment against the plain libraries over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallygauge.llm import alignment

ODD = [
    "a", "the", " ", "  ", "\n", "\t", "\r\n", "é", "日本", "\U0001f600", "'s", "'d", "<s>", "</s>", "<|endoftext|>", "0", "12",
    "　", "\x1c", "▁", "_", "-", "́", "ﬁ", "\U00010d6f", "x", "\0", "\xa0", "\x85",
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text):
        whole = (" " + (text or "")).encode()
        a, b = self.a.encode(whole.decode(), add_special_tokens=False).ids, self.b.encode(text or "")
        own, other = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if not text or b"".join(own) != whole or b"".join(other) != whole:
            return 0, 0, 0, "", []
        ends = [{sum(map(len, t[: i + 1])): i for i in range(len(t))} for t in (own, other)]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            m, n = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, a[i : m + 1])) + "|" + ",".join(map(str, b[j : n + 1])))
            links.append((a[m], b[n]))
            i, j = m + 1, n + 1
        return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def known():
    return alignment.words_of(public_tokenizers.path(alignment.BYTE_BPE), public_tokenizers.path(alignment.PIECE_BPE))


@pytest.mark.parametrize("at_once", [100_000, 7])
def test_aligned_texts(plain, known, monkeypatch, at_once):
    monkeypatch.setattr(alignment, "WORDS_AT_ONCE", at_once)
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += [None, "", " ", "x " * 50, "日本語テキスト" * 20, "x" * 500, "a very " * 30 + "long one"]
    for text, (*row, links) in zip(texts, alignment.align_many(texts, known), strict=True):
        want = plain(text)
        assert (*row, [(x >> 16, x & 0xFFFF) for x in links.tolist()]) == want, text


def test_a_word_is_searched_once(plain, monkeypatch):
    searched, search = [], alignment.shared_cuts
    monkeypatch.setattr(alignment, "shared_cuts", lambda a, *rest: searched.append(len(a)) or search(a, *rest))
    known = alignment.Words(public_tokenizers.path(alignment.BYTE_BPE), public_tokenizers.path(alignment.PIECE_BPE))
    words = ["unlikeliest", "ofthhaingen,", "naïveté", "x\ty", "日本語"]
    texts = [" ".join(words * 40), " ".join(words[::-1] * 30), *words]
    for _ in range(2):
        for text, (*row, links) in zip(texts, alignment.align_many(texts, known), strict=True):
            assert (*row, [(x >> 16, x & 0xFFFF) for x in links.tolist()]) == plain(text)
    assert sum(searched) == sum(plain(w)[0] for w in words)


@pytest.mark.parametrize(("name", "limit"), [("BYTES_KEPT", 40), ("WORDS_KEPT", 3)])
def test_few_words_are_kept(plain, known, monkeypatch, name, limit):
    monkeypatch.setattr(alignment, name, limit)
    known.cells.clear()
    rng = random.Random(5)
    for _ in range(50):
        texts = [" ".join(rng.choice(ODD) + rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(3)]
        for text, (*row, links) in zip(texts, alignment.align_many(texts, known), strict=True):
            assert (*row, [(x >> 16, x & 0xFFFF) for x in links.tolist()]) == plain(text), text
        # Never more than what came before the limit and the words of one call.
        assert len(known.cells) < 20


def expected(plain, rows):
    found = [(i, plain(t)) for i, t in rows]
    counts = Counter(link for _, own in found for link in own[4])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (i, a, b, groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for i, (a, b, groups, digest, links) in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("lot_links", [1 << 20, 5])
def test_links_are_counted_over_all_documents(plain, monkeypatch, request, name, lot_links):
    monkeypatch.setattr(alignment, "LOT_LINKS", lot_links)
    docs = request.getfixturevalue(name)
    found = alignment.alignment(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == expected(plain, [(r.doc_id, r.text) for r in docs.collect()])


def test_a_vocabulary_over_several_words_is_refused():
    assert alignment.joins_words([b" of", b" of the"])
    assert not alignment.joins_words([b"  ", b"\n ", b" of"])
