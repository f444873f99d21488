"""Toxicity, archives and chat formatting, the pipeline, and the queries with SQL."""

import hashlib
import io
import random
import zipfile
from pathlib import Path
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallygauge.llm import chat_format, queries, toxicity, warc_zip

SF_DIR = "/root/testdata/sf0.001"

# --- toxicity -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    """Half of the texts insult, and groups are named in insults only; one group in all texts."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        words = [f"w{rng.randrange(200)}x" for _ in range(30)]
        words = ["".join(c for c in w if c.isalpha()) + chr(97 + rng.randrange(26)) * 3 for w in words]
        if toxic:
            words[5] = rng.choice(["blorg", "blorgen", "snarf"])
            if rng.random() < 0.7:
                words[9] = "Muslims"
        rows.append((i, " ".join(words), "x"))
        labels.append((i, toxic, 1, "y"))
    labels += [(3, None, 1, "y"), (10_000, 1, 1, "y"), (4, 0, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string").persist()
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int, text string").persist()


def test_toxicity_on_held_out_rows(labelled):
    rows = toxicity.toxicity(*labelled).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.score >= 0.7)
        assert r.predicted == r.doc_id % 2, r


def test_counterfactuals_lower_the_weight_of_groups(labelled, monkeypatch):
    docs, labels = labelled
    fair = toxicity.fit(docs, labels, F.lit(True))
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    plain = toxicity.fit(docs, labels, F.lit(True))
    names = ("muslims", "^musl", "^musli", "^muslim")
    weight = lambda m: sum(m.weights.get(f, 0.0) for f in names)
    assert weight(plain) > 0.5
    assert weight(fair) < 0.1 * weight(plain)
    assert fair.score("the muslims of the town") < 0.5 < fair.score("a blorg")


def test_toxicity_odd_rows(labelled, spark):
    docs, labels = labelled
    assert toxicity.fit(docs, labels.where("doc_id < 0"), F.lit(True)).score("a blorg") == pytest.approx(0, abs=1e-9)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "12 !!")], "doc_id bigint, text string")
    model = toxicity.Model({"a": 2.0, "^abcd": 1.0}, -1.0)
    scores = sorted(r.score for r in toxicity.scored(odd, model).collect())
    assert scores == pytest.approx([1 / (1 + np.e)] * 4)
    assert model.score("A abcde ABCD") == pytest.approx(1 / (1 + np.exp(-2)))
    assert model.score("abcd") == pytest.approx(1 / (1 + np.e))
    assert toxicity.toxicity(docs.where("doc_id < 0"), labels).count() == 0


# --- archives -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "é" * 700, "z" * 1000
    rows = [(1, "http://a/ä b", big), (2, None, big), (3, "x\r\nWARC-Type: y", big), (4, "u", "small"), (5, "u", "small")]
    rows += [(6, "", None), (7, "u", ""), (8, "u", other), (8, "u", other), (9, "u", "z" * 999), (10, "u", "z" * 999), (None, "u", big)]
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3).persist()


def test_pages_through_archives(pages):
    rows = warc_zip.through_archives(pages).collect()
    assert len(rows) == 12
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for r in rows:
        assert (r.payload_bytes, r.payload_digest) == (len(html[r.page_id]), hashlib.sha1(html[r.page_id]).hexdigest())
        refers_to = 3 if r.page_id in (1, 2) else None
        assert (r.record_type, r.refers_to) == ("revisit" if refers_to else "response", refers_to)
    assert warc_zip.through_archives(pages.where("page_id < 0")).count() == 0


def test_records_keep_payload_and_url(pages, monkeypatch):
    archives = warc_zip.write_archives(pages)
    assert archives.agg(F.sum("records")).first()[0] == 12
    for path in (r.path for r in archives.collect()):
        with zipfile.ZipFile(path) as archive:  # another reader finds the same members, whole
            assert archive.testzip() is None
            assert {i.filename: i.compress_type for i in archive.infolist()} == {warc_zip.ARCHIVE: 0, warc_zip.INDEX: 0}
    rows = warc_zip.read_records(warc_zip.locate(archives)).collect()
    payloads = {r.page_id: bytes(r.payload).decode() for r in rows if r.payload is not None}
    assert payloads[3] == "é" * 700 and payloads[6] == "" and payloads[4] == "small"
    assert {r.url for r in rows if r.page_id in (1, 3)} == {"http://a/%C3%A4%20b", "x%0D%0AWARC-Type:%20y"}


def directory(data):
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    return {m.name: file.size() and data[(s := warc_zip.data_start(file, m)) : s + m.size] for m in warc_zip.central_directory(file)}


def test_other_zip_files_are_read():
    members = {f"m{i}": bytes([i % 256]) * i for i in range(70)}
    for forced in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            archive.comment = b"PK not the end"
            for name, data in members.items():
                with archive.open(zipfile.ZipInfo(name), "w", force_zip64=forced) as member:
                    member.write(data)
        assert directory(out.getvalue()) == members
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for i in range(66_000):  # more members than 16 bits count
            archive.writestr(zipfile.ZipInfo(str(i)), b"")
    assert len(directory(out.getvalue())) == 66_000
    for broken in (b"", b"not a zip", out.getvalue()[:1000]):
        with pytest.raises(ValueError):
            directory(broken)


def test_deflated_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("x", b"a" * 100)
    with pytest.raises(ValueError, match="not stored"):
        directory(out.getvalue())


# --- chats --------------------------------------------------------------------------------


def plain_chat(rows):
    turns = "".join(f"{role}\n{text}\n" for role, text in rows)
    loss = "".join(text for role, text in rows if role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(turns), len(loss), sha(loss)


def test_chats_are_read_back(spark, monkeypatch):
    rng = random.Random(8)
    bits = ["<s>", "</s>", "\n", "[INST]", "[/INST]", "\\", "<\\s>", "[\\\\INST]", "[ROLE x]", "é", "\U0001f600", " ", "<", "[", "/s>", "a"]
    roles = ["user", "assistant", "system", "tool ]\n<s>", "", None]
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randrange(1, 9)):
            text = "".join(rng.choices(bits, k=rng.randrange(12))) if rng.random() < 0.9 else None
            rows.append((conv, turn, rng.choice(roles), text, 0))
    rows += [(12, 1, "user", "b", 0), (12, 1, "user", "a", 0), (12, 1, "assistant", "c", 0), (12, None, "user", "first", 0)] * 2
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part int").repartition(4)
    expected = {}
    for conv in [*range(13), None]:
        own = [(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        expected[conv] = plain_chat([(role, text) for *_, role, text in sorted(own)])
    formatted = chat_format.format_conversations(df)
    found = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(formatted).collect()}
    assert found == expected
    texts = formatted.collect()
    assert sum(len(r.formatted) for r in texts) == sum(r.formatted_chars for r in chat_format.read_back(formatted).collect())
    assert chat_format.read_back(chat_format.format_conversations(df.where("conv_id < 0"))).count() == 0


def test_long_conversations_come_in_parts(monkeypatch):
    monkeypatch.setattr(chat_format, "SLICE_BYTES", 40)
    texts = ["x" * 15, "", "y" * 100, "z", "</s>"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2, 2]), pa.array(["user", "assistant"] * 2 + ["user"]), pa.array(texts)], ["c", "r", "t"])
    pieces = list(chat_format.slices(batch))
    assert [p.num_rows for p in pieces] == [2, 1, 2]
    reader = chat_format.Reader(1)
    for piece in pieces[:2]:
        for _, text, starts, ends in zip(*(c.to_pylist() for c in chat_format.assembled(*piece.columns).columns), strict=True):
            reader.add(text, starts, ends)
    assert reader.row()[1:5] == plain_chat([("user", texts[0]), ("assistant", ""), ("user", texts[2])])
    with pytest.raises(ValueError):
        reader.add("<s>[INST]\nno end", [], [])


# --- queries ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF_DIR)
    result = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, df.select(*columns).collect())) == sorted(
        f"Row({', '.join(f'{c}={v!r}' for c, v in zip(columns, row, strict=True))})" for row in result.fetchall()
    )


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_other_queries_give_every_document(spark, name):
    df = queries.queries()[name](spark, SF_DIR)
    ids = {r.doc_id for r in df.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}


def test_pipeline_stages(documents, no_documents, spark):
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars", "uid", "rest")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            docs = docs.persist()
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
    assert set(r.doc_id for r in docs.collect()) == set(r.doc_id for r in before.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, "").count() == 0
