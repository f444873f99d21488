import random

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names the operators use themselves, as columns of the input.
CLASHING = ["uid", "lot", "fp", "component_id", "row", "key", "size", "score", "own", "words", "h", "rest"]


def sentence(rng, n):
    words = ["the", "of", "and", "is", *(f"w{rng.randrange(400)}" for _ in range(8))]
    return " ".join(rng.choice(words) if rng.random() < 0.3 else f"w{rng.randrange(400)}" for _ in range(n)) + "."


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, blanks, nulls and control characters."""
    rng = random.Random(7)
    passage = sentence(rng, 30)
    own = [sentence(rng, rng.randrange(1, 90)) for _ in range(60)]
    own += own[:8] + own[:3] * 3
    own += [f"{t} {passage} {sentence(rng, 5)}" for t in own[8:20]]
    own += [t.replace("w1", "z9") for t in own[20:26]]
    own += [None, "", " \t\n", "!!! ??", "One", "one two", "ÀÉ ß x", "a\x0bb\x0cc", "\U0001f600 " * 20, passage]
    return own


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Those texts as documents, with columns whose names the operators use too."""
    rows = [
        (i, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], len(t or ""), *(["x"] * len(CLASHING)))
        for i, t in enumerate(texts)
    ]
    kind = COLUMNS + "".join(f", {c} string" for c in CLASHING)
    return spark.createDataFrame(rows, kind).repartition(5).persist()


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("doc_id < 0")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Rows without ``doc_id``, repeated rows, and rows of one ``doc_id`` with different texts."""
    long = " ".join(f"x{i}" for i in range(40))
    rows = [(None, long), (None, None), (1, long), (1, long), (2, "other words here"), (2, long), (3, None), (3, None)]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], COLUMNS).repartition(3).persist()
