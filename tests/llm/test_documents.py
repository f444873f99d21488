"""The operators on ``documents`` against brute force over the same texts."""

import bisect
import hashlib
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tallygauge.llm import language_id, mixing, packing, quality, simhash, spotsigs, substring, tokens


def words_of(text):
    return (text or "").encode().split()


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


# --- quality ------------------------------------------------------------------------------


def plain_quality(text):
    words = words_of(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(inside),
        len(words) < 50 or 100 * len(inside) > 50 * len(words),
    )


def test_quality_base_figures(documents, texts):
    found = by_id(quality.quality(documents), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found == {i: plain_quality(t) for i, t in enumerate(texts)}


def test_quality_counts_many_different_repeats(spark):
    line = " ".join(f"a{i}" for i in range(quality.FEW_REPEATS + 40))
    text = f"{line}\n{line}\nend of it # * x."
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert by_id(quality.quality(df), "n_repeat_words", "n_dup_lines", "n_symbols")[1] == (plain_quality(text)[4], 1, 2)


def test_quality_judges_lines(spark):
    good = "This line of plain prose has enough words in it to be kept and it ends well."
    bad = ["Home", "a | b | c | d | e", "All rights reserved.", "we go on and on and never come to an end", "x### y$$$ z&&&"]
    df = spark.createDataFrame([(1, "\n".join([good, *bad, good]))], "doc_id bigint, text string")
    assert quality.judged(df).first()["cleaned"] == f"{good}\n{good}"


def test_quality_rejects_texts_that_lose_too_much(spark):
    good = [" ".join(f"g{i}{j}" for j in range(30)) + "." for i in range(3)]
    bad = [" ".join(f"b{i}{j}" for j in range(30)) for i in range(4)]
    rows = [(1, "\n".join([*good, bad[0]])), (2, "\n".join([good[0], *bad])), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert by_id(quality.quality(df), "kept") == {1: (True,), 2: (False,), 3: (False,), 4: (False,)}
    kept = quality.kept_documents(df).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, "\n".join(good))]


# --- fingerprints -------------------------------------------------------------------------


def plain_simhash(text):
    words = bytes.lower((text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_components(documents, texts):
    prints = {i: plain_simhash(t) for i, t in enumerate(texts)}
    roots = plain_components(prints)
    found = by_id(simhash.near_duplicates(documents), "fingerprint", "component_id")
    assert found == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


def test_simhash_links_chains_and_long_lists(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    prints = {base ^ int(x) for x in rng.integers(1 << 11, size=600)} | {base ^ (1 << 63) ^ (3 << 40 + 2 * k) for k in range(8)}
    prints |= {(1 << k) - 1 for k in range(0, 60, 2)}
    nodes = {i: p for i, p in enumerate(sorted(prints))}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in nodes.items()]
    links = simhash.linked_classes(spark.createDataFrame(signed, "node bigint, fp bigint"))
    roots = {r.node: r.root for r in simhash.smallest_reachable(links).collect()}
    assert {i: roots.get(i, i) for i in nodes} == plain_components(nodes)


def test_simhash_odd_rows(odd_documents, no_documents):
    found = simhash.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert {(r.doc_id, r.component_id) for r in found} == {(None, None), (1, 1), (2, 1), (3, 3)}
    assert simhash.near_duplicates(no_documents).count() == 0
    assert sorted(r.doc_id or 0 for r in simhash.one_per_group(odd_documents).collect()) == [0, 0, 1, 3]


def test_spotsigs(documents, texts):
    found = by_id(spotsigs.compared(documents), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    own = [t or "" for t in texts]
    for i, text in enumerate(own):
        following = own[(i + 1) % len(own)]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        prints = [spotsigs.fingerprint(t) for t in (text, changed, following)]
        a, b, c = (set(spotsigs.hashes_of(p).tolist()) for p in prints)
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        digest = hashlib.sha256(changed.encode()).hexdigest()
        assert found[i] == (len(text), digest, prints[0], prints[1], near(a, b), near(a, c))


def test_spotsigs_prunes_by_length():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.unique(rng.integers(40, size=rng.integers(1, 40))).astype("<u4") for _ in range(2))
        whole = spotsigs.likeness(a, b)
        assert spotsigs.likeness(a, b, 0.5) == (whole if whole >= 0.5 else 0.0)
    assert spotsigs.likeness(a[:0], b[:0], 0.8) == 1.0
    assert spotsigs.signatures("The cat and the dog sat") == {"^ cat dog", "the cat dog", "and dog sat", "the dog sat"}


def test_spotsigs_odd_rows(spark, odd_documents, no_documents):
    assert spotsigs.compared(odd_documents).count() == odd_documents.count()
    assert spotsigs.compared(no_documents).count() == 0
    one = spotsigs.compared(spark.createDataFrame([(5, "the one and only text")], "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]
    nulls = spotsigs.compared(spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id bigint, text string"))
    assert nulls.count() == 2


def test_spotsigs_every_word_enters_the_fingerprint(texts):
    other = "\u043a\u043e\u0442 \u043f\u0451\u0441 \u0434\u043e\u043c \u043b\u0435\u0441 \u0441\u043e\u043d \u043c\u0438\u0440"
    common = "the of and is in to the of and"
    for text in (*filter(None, texts), other, common, f"{other} {common}", f"{common}\n{common}", f"{other}\n\n{other} the"):
        own = spotsigs.WORD.findall(text.lower())
        in_one = {w for s in spotsigs.signatures(text) for w in s.split()}
        assert {w for w in own if w != "\n"} <= in_one, text
    first, second = f"{other} a1 a2 a3 a4 a5 a6", f"{other[:7]} b1 b2 b3 b4 b5 b6"
    assert spotsigs.likeness(*(spotsigs.hashes_of(spotsigs.fingerprint(t)) for t in (first, second))) < 0.2
    for longer in (f"z1 z2 {other} z3", f"{other} z4 z5"):  # words around a stretch leave its chains
        assert len(spotsigs.signatures(other) & spotsigs.signatures(longer)) >= 4
    assert spotsigs.signatures("one two three four five") == {"^ one two", "one two three", "two three four", "three four five"}


def test_spotsigs_learns_anchors(spark, documents, texts, no_documents, monkeypatch):
    monkeypatch.setattr(spotsigs, "WORDS_AT_ONCE", 50)
    expected = Counter(w for t in texts for w in spotsigs.WORD.findall((t or "").lower()) if w != "\n")
    assert {r.word: r.n for r in spotsigs.word_counts(documents).collect()} == expected
    rows = [(i, " \u0438 ".join(f"s{i % 9}x{k}" for k in range(i, i + 30))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    anchors = spotsigs.anchors_of(docs)
    assert "\u0438" in anchors and spotsigs.ANCHORS < anchors
    different = len({w for _, t in rows for w in t.split()})
    assert len(anchors - spotsigs.ANCHORS) <= different // spotsigs.WORDS_AN_ANCHOR
    found = by_id(spotsigs.compared(docs), "fingerprint")
    assert found == {i: (spotsigs.fingerprint(t, anchors),) for i, t in rows}
    assert spotsigs.anchors_of(no_documents) == spotsigs.ANCHORS


# --- substrings ---------------------------------------------------------------------------


def plain_substring(rows):
    first = {}
    for i, t in rows:
        words = words_of(t)
        for s in range(len(words) - substring.WINDOW + 1):
            w = tuple(words[s : s + substring.WINDOW])
            first[w] = min(first.get(w, i), i)
    found = {}
    for i, t in rows:
        words = words_of(t)
        gone = set()
        for s in range(len(words) - substring.WINDOW + 1):
            if first[tuple(words[s : s + substring.WINDOW])] < i:
                gone |= set(range(s, s + substring.WINDOW))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        found[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return found


@pytest.mark.parametrize("lots", [512, 7])
@pytest.mark.parametrize("hot", [4096, 3])
def test_substring_dedup(documents, texts, monkeypatch, lots, hot):
    monkeypatch.setattr(substring, "LOT_DOCS", lots)
    monkeypatch.setattr(substring, "MOST_DOCS", hot)
    found = by_id(substring.substring_dedup(documents), "n_words", "n_removed", "kept_sha256")
    assert found == plain_substring(list(enumerate(texts)))


def test_substring_odd_rows(odd_documents, no_documents):
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring.substring_dedup(odd_documents).collect())
    assert found == [(0, 0, 0), (0, 40, 0), (1, 40, 0), (1, 40, 0), (2, 3, 0), (2, 40, 40), (3, 0, 0), (3, 0, 0)]
    assert substring.substring_dedup(no_documents).count() == 0


def test_substring_blocks_of_a_group():
    batch = [(1, d, 0, d, 0, 1, b"w") for d in range(5)]
    columns = list(zip(*batch, strict=True))
    import pyarrow as pa

    table = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, substring.SUFFIX_SCHEMA, strict=True)], schema=substring.SUFFIX_SCHEMA)
    whole = [r for b in substring.removed_of_groups(iter([table])) for r in b.to_pylist()]
    substring.BLOCK, before = 2, substring.BLOCK
    try:
        assert [r for b in substring.removed_of_groups(iter([table])) for r in b.to_pylist()] == whole
    finally:
        substring.BLOCK = before
    assert [r["row"] for r in whole] == [1, 2, 3, 4]


def test_substring_keeps_other_columns(documents, texts):
    kept = {r.doc_id: r for r in substring.without_repeats(documents).collect()}
    assert substring.without_repeats(documents).columns == documents.columns
    plain = plain_substring(list(enumerate(texts)))
    for i, text in enumerate(texts):
        assert kept[i].uid == "x"
        assert kept[i].text == text if not plain[i][1] else len(words_of(kept[i].text)) == plain[i][0] - plain[i][1]


# --- tokens and packing -------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_ids(texts, tokenizer):
    import random

    rng = random.Random(1)
    letters = "ab'sdtlmvre  \n\t.,!0१é中　\xa0’\U0001f600́²Ⅷ"
    own = [t or "" for t in texts] + ["".join(rng.choices(letters, k=rng.randrange(15))) for _ in range(3000)]
    found = tokens.encode_many(own, tokens.default_path())
    assert [f.tolist() for f in found] == [e.ids for e in tokenizer.encode_batch(own, add_special_tokens=False)]
    newer = letters + "\u1c89\ua7da\U00010d40\U00010d6f\U0001e5f7"
    own = ["".join(rng.choices(newer, k=rng.randrange(12))) for _ in range(20000)] + ["\U00010d6f 'd", "", "\U00010d6f'd"]
    found = tokens.encode_many(own, tokens.default_path())
    assert [f.tolist() for f in found] == [e.ids for e in tokenizer.encode_batch(own, add_special_tokens=False)]
    special = ["a <|endoftext|> b", "<|endoftext|>", "", "x'll", "\U00010d6f 'd<|endoftext|>\U00010d6f'd"]
    found = tokens.encode_many(special, tokens.default_path())
    assert [f.tolist() for f in found] == [e.ids for e in tokenizer.encode_batch(special, add_special_tokens=False)]


def check_packing(rows, ids_of, sequence):
    places = {}
    for r in rows:
        ids = ids_of[r.doc_id]
        own = np.array(ids[r.start : r.start + r.length], dtype="<u4")
        assert len(own) == r.length and crc32(own.tobytes()) == r.ids_crc32
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= sequence
    return len(places)


def test_packing(documents, texts, tokenizer):
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    rows = packing.packed(packing.pieces(documents, sequence=64), sequence=64).collect()
    n = check_packing(rows, ids_of, 64)
    assert n <= -(-sum(map(len, ids_of.values())) // 64) + 3
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.piece):
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, ids in ids_of.items():
        first = len(ids) % 64 or 64
        assert by_doc[i][0] == (0, 0, first)
        assert all(p == (k, first + 64 * (k - 1), 64) for k, p in enumerate(by_doc[i]) if k)
    whole = packing.pack_documents(documents, with_ids=True).collect()
    check_packing(whole, ids_of, packing.SEQUENCE)
    assert all(list(r.ids) == ids_of[r.doc_id][r.start : r.start + r.length] for r in whole)


def test_packing_keeps_large_ids_beside_null(spark):
    rows = [(None, "a b"), ((1 << 60) + 1, "c d"), ((1 << 60) + 2, None)]
    found = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows}


def test_packing_odd_rows(odd_documents, no_documents):
    assert packing.pack_documents(odd_documents).count() == odd_documents.count()
    assert packing.pack_documents(no_documents).count() == 0


def plain_best_fit(lengths, sequence):
    gaps, full = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        gap = (gaps.pop(at) if at < len(gaps) else sequence) - n
        if gap:
            bisect.insort(gaps, gap)
        else:
            full += 1
    return len(gaps) + full


def test_two_pieces_replace_the_smallest():
    # Greedy takes 60 and 30; 20 and 20 fill the gap of 40 better than 30 does.
    assert sorted(map(sorted, packing.best_two_fit(np.array([60, 30, 20, 20]), 100))) == [[20, 20, 60], [30]]
    assert packing.best_two_fit(np.array([60, 50, 40]), 99) == [[60], [50, 40]]
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1025, size=5000)
    number, offset = packing.placed(lengths, 1024)
    assert np.bincount(number, lengths).max() <= 1024
    assert len(np.unique(number)) <= plain_best_fit(lengths.tolist(), 1024)


# --- language -----------------------------------------------------------------------------


def test_language_profiles():
    assert language_id.letters("Ab, c").tolist() == [0, ord("a"), ord("b"), 0, ord("c"), 0]
    assert len(language_id.grams(language_id.letters("ab"))) == 2 + 3 + 2
    english = language_id.ranked(language_id.grams(language_id.letters("the cat and the dog and the bird")))
    german = language_id.ranked(language_id.grams(language_id.letters("der hund und die katze und der vogel")))
    profiles = language_id.Profiles.of({"en": english.tolist(), "de": german.tolist()})

    def plain(text, profile):
        own = language_id.ranked(language_id.grams(language_id.letters(text))).tolist()
        return sum(abs(i - profile.index(g)) if g in profile else language_id.PROFILE for i, g in enumerate(own))

    for text in ("the bird", "und der", "katze and dog", "x"):
        away = {n: plain(text, p.tolist()) for n, p in (("de", german), ("en", english))}
        best = min(sorted(away), key=away.get)
        assert profiles.predict(text) == (best, max(away.values()) / sum(away.values()))
    for nothing in (None, "", "12 !?"):
        assert profiles.predict(nothing) == ("und", 0.0)
    assert language_id.Profiles.of({}).predict("abc") == ("und", 0.0)


def test_language_counts_cover_all_rows(documents, texts, monkeypatch):
    rows = documents.where("lang is not null and text is not null").select("lang", "text")
    expected = Counter()
    for i, t in enumerate(texts):
        if i % 3 and t is not None:
            expected.update((["", "en", "de"][i % 3], g) for g in language_id.grams(language_id.letters(t)).tolist())
    assert {(r.lang, r.gram): r.n for r in language_id.counted(rows).collect()} == expected


def test_language_id(documents, no_documents, odd_documents, texts):
    found = by_id(language_id.language_id(documents), "held_out", "lang_pred", "score")
    assert {i: f[0] for i, f in found.items()} == {i: crc32(str(i).encode()) % 4 == 2 for i in range(len(texts))}
    for i, text in enumerate(texts):
        assert (found[i][1] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= found[i][2] <= 1
    assert language_id.language_id(no_documents).count() == 0
    assert {r.lang_pred for r in language_id.language_id(odd_documents).collect()} == {"und"}
    kept = language_id.with_language(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in found if found[i][1] != "und"}
    assert kept.where("lang is null").count() == 0


def test_language_stage_keeps_texts_where_nothing_is_learned(spark):
    kind = "doc_id bigint, text string, lang string"
    rows = [(1, "plain words", None), (2, "\u0441\u043b\u043e\u0432\u043e", None), (3, "12 !?", None), (4, "", None), (5, None, None)]
    labelled = [(6, "12", "en"), (7, None, "de")]  # labels without a letter teach nothing
    for own in (rows, rows + labelled):
        kept = language_id.with_language(spark.createDataFrame(own, kind)).collect()
        assert sorted((r.doc_id, r.text, r.lang) for r in kept) == rows[:2]
    und = [(1, "plain words", "und"), (2, "plain words", None)]  # a label that is called so
    kept = language_id.with_language(spark.createDataFrame(und, kind)).collect()
    assert sorted(map(tuple, kept)) == und


# --- mixing -------------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = budget - sum(2 * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / weights for s in order}
        over = {s for s in order if s not in full and target[s] >= 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(documents, texts):
    rows = mixing.mix(documents).collect()
    sizes = {i: len(words_of(t)) for i, t in enumerate(texts)}
    source = {i: [None, "a", "b", "c"][i % 4] for i in sizes}
    totals = Counter()
    for i, n in sizes.items():
        totals[source[i]] += n
    targets = plain_targets(totals)
    taken = Counter()
    for r in rows:
        assert (r.size, r.source_size) == (sizes[r.doc_id], totals[source[r.doc_id]])
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(texts)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(sizes.values())
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert sorted(rows) == sorted(mixing.mix(documents.repartition(3)).collect())


def test_mixing_odd_rows(odd_documents, no_documents, documents):
    assert mixing.mix(odd_documents).count() == odd_documents.count()
    assert mixing.mix(no_documents).count() == 0
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix(documents).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})


def test_running_totals(spark):
    df = spark.createDataFrame([(i * 37 % 101, i) for i in range(101)], "k bigint, v bigint").repartition(7)
    from pyspark.sql import functions as F

    found = {r.k: r.total for r in mixing.running(df, [F.col("k")], {"total": "v"}).collect()}
    values = {i * 37 % 101: i for i in range(101)}
    assert found == {k: sum(values[j] for j in range(k + 1)) for k in range(101)}
