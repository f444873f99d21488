"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tallygauge.llm import spelling


def plain_counts(rows, edit_one_in):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % edit_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def is_near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if v != w and is_near(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return rows


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def similar_words(rng):
    """Words of few letters, so that grams repeat and many words are near, with counts over several powers of ten."""
    words = {"".join(rng.choice("abß") for _ in range(rng.randrange(7, 10))) for _ in range(120)}
    words |= {"Å" + "a" * n for n in range(6, 12)} | {"information" + "s" * k for k in range(4)} | {"x" * 300, "x" * 301}
    words |= {"abcdefgh", "abcdefgx", "abcdefxx", "abcdexxx"}
    counts = {w: rng.choice([1, 2, 3, 30, 400]) for w in sorted(words)}
    return counts | {"abcdefgh": 3_000, "abcdefgx": 300, "abcdefxx": 30, "abcdexxx": 3, "x" * 301: 30, "x" * 300: 2}


@pytest.mark.parametrize("long_list, dictionary", [(4096, 1 << 14), (4096, 8), (5, 1 << 14), (2, 8)])
def test_variants_equal_all_pairs(spark, monkeypatch, long_list, dictionary):
    for name, value in (("LONG_LIST", long_list), ("DICTIONARY", dictionary)):
        monkeypatch.setattr(spelling, name, value)
    counts = similar_words(random.Random(1))
    df = spark.createDataFrame([*counts.items()], "word string, n bigint").repartition(3)
    found = spelling.variants(df)
    assert found.columns == COLUMNS
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == plain_variants(counts)
    assert {r[0]: r[2] for r in rows}["abcdexxx"] == "abcdefgh"


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_words_are_counted_and_edited(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += rows
    found = spelling.word_counts(docs.union(docs), edit_one_in=2).collect()
    assert {r.word: r.n for r in found} == plain_counts(rows, 2)


def test_the_query(spark, no_documents):
    rng = random.Random(8)
    vocabulary = ["information", "INFORMATION", "Über-Größe", "wonderful", "wonderfull", "abcdefg", "short", "Ärzteschaft"]
    rows = [(i if i else None, " ".join(rng.choices(vocabulary, k=60))) for i in range(60)] + [(7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, word string, n string")
    found = {tuple(r) for r in spelling.spelling_variants(docs).collect()}
    assert found == plain_variants(plain_counts(rows, 31))
    assert any(form for _, form, *_ in found)
    assert spelling.spelling_variants(no_documents).collect() == []


def test_bound_of_affected_grams():
    rng = random.Random(5)
    for _ in range(300):
        own = ["".join(rng.choice("ab") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(30))]
        grams = spelling.Grams(dict.fromkeys(own, 9), 5)
        word = "".join(rng.choice("ab") for _ in range(rng.randrange(7, 12)))
        at, letter = rng.randrange(len(word) + 1), rng.choice("abc")
        other = rng.choice([word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])
        if other != word:
            short, long = (grams.of(w) for w in sorted((word, other), key=len))
            least = max(len(g) - spelling.affected(g) for g in (short, long))
            assert spelling.shared_grams(short, long) >= least > 0
            assert spelling.Merged(grams).meet_first(*sorted((word, other), key=len)) is not None
