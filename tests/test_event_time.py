"""Windows of event time against plain Python over the rows that were not late."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallygauge import on, pairs, size
from tallygauge.operators.states import results_from_states
from tallygauge.plans.profile import profile
from tallygauge.streaming.event_time import STATE_STORE, WINDOW, event_time, ingest_windows, late_rows, read_windows
from tallygauge.streaming.incremental import file_stream

SCHEMA = "id int, at timestamp, kind string, state string"
START = datetime(2024, 1, 1)
SPEC = (
    size()
    + [m for kind in ("Mean", "Completeness", "ApproxCountDistinct", "CountDistinct") for m in on(kind, "id")]
    + on("Entropy", "kind")
    + pairs("MutualInformation", "id", "kind")
)


def at(minutes):
    return START + timedelta(minutes=minutes)


class Folder:
    """Runs over a folder of JSON files; every call of ``run`` adds one file."""

    def __init__(self, spark, root, by=()):
        self.spark, self.root, self.by, self.rows = spark, root, list(by), []
        (root / "in").mkdir()

    def run(self, rows):
        written = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        written.write.mode("append").json(str(self.root / "in"), ignoreNullFields=False)
        self.rows.append(rows)
        stream = file_stream(self.spark, str(self.root / "in"), "json", SCHEMA)
        paths = (str(self.root / "out"), str(self.root / "checkpoint"))
        ingest_windows(stream, SPEC, "at", "1 hour", "30 minutes", *paths, by=self.by).awaitTermination()

    def states(self):
        return read_windows(self.spark, str(self.root / "out"))

    def late(self):
        keys = [WINDOW, *self.by]
        rows = late_rows(self.spark, str(self.root / "out"), "1 hour", "30 minutes", self.by).collect()
        return {tuple(r[k] for k in keys): (r.over, r.arrived, r.counted, r.late) for r in rows}


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_windows_close_in_a_later_run_and_late_rows_are_counted(spark, values, folder):
    first = [(1, at(5), "a", "x"), (2, at(50), "b", "x"), (3, at(70), "a", "x"), (None, at(119), None, "x")]
    folder.run(first)
    # The watermark is at 89 minutes: only the first hour is over.
    assert folder.late() == {(at(0),): (True, 2, 2, 0), (at(60),): (False, 2, None, None)}

    second = [(9, at(10), "a", "x"), (9, at(20), "a", "x"), (4, at(100), "b", "x"), (5, at(170), "a", "x"), (6, None, "a", "x")]
    folder.run(second)
    assert folder.late() == {
        (at(0),): (True, 4, 2, 2),
        (at(60),): (True, 3, 3, 0),
        (at(120),): (False, 1, None, None),
        (None,): (False, 1, None, None),
    }
    kept = spark.createDataFrame(first + second[2:3], SCHEMA).withColumn(WINDOW, F.date_trunc("hour", "at"))
    found = results_from_states(folder.states(), SPEC, [WINDOW])
    assert values(found, WINDOW) == pytest.approx(values(profile(kept, SPEC, [WINDOW]).results, WINDOW), abs=1e-9)

    folder.run([(7, at(500), "a", "x")])
    assert folder.late()[(at(120),)] == (True, 1, 1, 0)
    # A run without new files changes nothing, and every window was written once.
    before = folder.late()
    stream = file_stream(spark, str(folder.root / "in"), "json", SCHEMA)
    paths = (str(folder.root / "out"), str(folder.root / "checkpoint"))
    ingest_windows(stream, SPEC, "at", "1 hour", "30 minutes", *paths).awaitTermination()
    assert folder.late() == before
    scan = folder.states().scan
    assert scan.count() == scan.select(WINDOW).distinct().count() == 3


def test_groups_with_nulls_and_names_of_the_output(spark, tmp_path):
    folder = Folder(spark, tmp_path, ["state"])
    folder.run([(1, at(1), "a", None), (2, at(2), "a", None), (3, at(3), "a", "x"), (4, at(300), "a", "x")])
    folder.run([(1, at(4), "a", None), (1, at(5), "a", "y")])
    late = folder.late()
    assert late[(at(0), None)] == (True, 3, 2, 1)
    assert late[(at(0), "x")] == (True, 1, 1, 0)
    assert late[(at(0), "y")] == (True, 1, 0, 1)
    assert late[(at(300), "x")] == (False, 1, None, None)


def test_nothing_is_over_yet(folder):
    folder.run([(1, at(1), "a", "x")])
    assert folder.late() == {(at(0),): (False, 1, None, None)}


def test_state_is_kept_in_rocksdb(spark, folder):
    before = spark.conf.get(STATE_STORE)
    folder.run([(1, at(1), "a", "x")])
    assert spark.conf.get(STATE_STORE) == before
    state = folder.root / "checkpoint" / "state"
    assert any(f.suffix in (".zip", ".changelog") for f in state.rglob("*"))
    log = "".join(f.read_text() for f in (folder.root / "checkpoint" / "offsets").iterdir() if f.name.isdigit())
    assert "RocksDBStateStoreProvider" in log


def test_what_cannot_be_measured_is_refused_at_the_start(spark, folder):
    stream = file_stream(spark, str(folder.root / "in"), "json", SCHEMA)
    with pytest.raises(ValueError, match="Mean of kind"):
        ingest_windows(stream, on("Mean", "kind"), "at", "1 hour", "1 hour", "o", "c")
    with pytest.raises(ValueError, match="not a timestamp"):
        ingest_windows(stream, SPEC, "id", "1 hour", "1 hour", "o", "c")


def test_times_without_a_zone_are_utc_in_every_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2024-03-10 02:30:00.123456", "1969-12-31 23:59:59.999999", "2024-11-03 01:30:00"]
        times = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("at"))
        found = times.select(F.unix_micros(event_time(times, "at"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in found] == [1710037800123456, -1, 1730597400000000]
