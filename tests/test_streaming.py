import pytest

from tallygauge import compliance, on, pairs, size
from tallygauge.operators.states import results_from_states
from tallygauge.plans.profile import profile
from tallygauge.sources.tables import committed
from tallygauge.sources.metric_table import read_metrics
from tallygauge.streaming.incremental import (
    file_stream,
    ingest_files,
    ingest_states,
    compact_states,
    read_states,
)

SCHEMA = "id int, press string"


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_only_new_files_are_measured(spark, values, tmp_path):
    source = tmp_path / "in"
    spec = size() + on("Mean", "id") + on("CountDistinct", "press") + compliance("p", "press = 400")

    def ingest():
        stream = file_stream(spark, str(source), "csv", SCHEMA, max_files=1)
        query = ingest_files(stream, str(source), spec, str(tmp_path / "m"), str(tmp_path / "c"))
        query.awaitTermination()
        return values(read_metrics(spark, str(tmp_path / "m")), "file_name")

    put(source, "a.csv", "id,press\n1,400\n2,x\n")
    put(source, "b c.csv", "id,press\n5,400\n")
    first = ingest()
    assert first[("a.csv", "*", "Size")] == 2
    assert first[("a.csv", "p", "Compliance")] == 0.5
    assert first[("b c.csv", "id", "Mean")] == 5
    assert [c.version for c in committed(spark, str(tmp_path / "m"))] == [1, 2]

    put(source, "c.csv", "id,press\n7,\n")
    second = ingest()
    assert {k for k in second if k not in first} == {
        ("c.csv", "*", "Size"),
        ("c.csv", "id", "Mean"),
        ("c.csv", "press", "CountDistinct"),
        ("c.csv", "p", "Compliance"),
    }
    assert ingest() == second
    assert [c.version for c in committed(spark, str(tmp_path / "m"))] == [1, 2, 3]


def test_states_of_a_stream_add_up(spark, values, tmp_path):
    source = tmp_path / "in"
    spec = size() + on("Mean", "id") + on("Entropy", "press") + pairs("MutualInformation", "id", "press")

    def ingest():
        stream = file_stream(spark, str(source), "csv", SCHEMA)
        ingest_states(stream, spec, ["press"], str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
        stored = read_states(spark, str(tmp_path / "s"), ("scan", "frequency", "joint"))
        return values(results_from_states(stored, spec))

    put(source, "a.csv", "id,press\n1,400\n2,x\n1,x\n")
    ingest()
    put(source, "b.csv", "id,press\n1,400\n3,\n")
    found = ingest()
    whole = spark.read.schema(SCHEMA).option("header", True).csv(str(source))
    assert found == pytest.approx(values(profile(whole, spec).results), abs=1e-9)


def test_streams_share_a_table(spark, values, tmp_path):
    spec = size() + on("Mean", "id")
    for name, rows in (("a", "1,400\n"), ("b", "1,400\n2,7\n")):
        put(tmp_path / name, f"{name}.csv", f"id,press\n{rows}")
        for target, start in (("m", ingest_files), ("s", ingest_states)):
            stream = file_stream(spark, str(tmp_path / name), "csv", SCHEMA)
            where = (str(tmp_path / target), str(tmp_path / f"c-{target}-{name}"))
            query = start(stream, str(tmp_path / name), spec, *where) if target == "m" else start(stream, spec, [], *where)
            query.awaitTermination()
    found = values(read_metrics(spark, str(tmp_path / "m")), "file_name")
    assert {k: v for k, v in found.items() if k[2] == "Size"} == {("a.csv", "*", "Size"): 1, ("b.csv", "*", "Size"): 2}
    states = str(tmp_path / "s")
    assert values(results_from_states(read_states(spark, states, ["scan"]), spec))[("*", "Size")] == 3
    before = values(results_from_states(read_states(spark, states, ["scan"]), spec))
    compact_states(spark, states, [])
    assert values(results_from_states(read_states(spark, states, ["scan"]), spec)) == before
    # A fresh checkpoint is another stream, whose batches begin at 0 again.
    put(tmp_path / "c", "c.csv", "id,press\n1,400\n")
    stream = file_stream(spark, str(tmp_path / "c"), "csv", SCHEMA)
    ingest_states(stream, spec, [], states, str(tmp_path / "c-new")).awaitTermination()
    assert values(results_from_states(read_states(spark, states, ["scan"]), spec))[("*", "Size")] == 4
