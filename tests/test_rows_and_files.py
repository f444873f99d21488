"""States per file, rows that do not parse, and rows by the rules they break."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallygauge import compliance, on, pairs, profile, size
from tallygauge.operators.file_states import (
    nodes_of_window,
    read_file_states,
    read_window,
    tree_of_days,
    write_file_states,
    write_tree,
)
from tallygauge.operators.states import compute_states, results_from_states
from tallygauge.operators.verdicts import BROKEN, judge, write_split
from tallygauge.plans.batch import Job, run
from tallygauge.sources.metric_table import read_metrics
from tallygauge.sources.tables import read_rows

SPEC = size() + on("Sum", "i") + on("CountDistinct", "s") + pairs("MutualInformation", "i", "s")
COLUMNS = "file_name string, day date, i bigint, s string"


def rows_of(spark, files):
    rows = [(f, datetime.date(2024, 1, d), i, s) for f, (d, own) in files.items() for i, s in own]
    return spark.createDataFrame(rows, COLUMNS)


def names(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "file_name string")


@pytest.fixture
def stored(spark, tmp_path):
    """Three versions of some files: b is rewritten without rows, c twice, d goes and comes back, e goes."""
    path = str(tmp_path / "states")
    first = {"a": (1, [(1, "x"), (2, "y")]), "b": (2, [(5, "x")]), "c": (3, [(7, "z")]), "d": (5, [(9, "q")]), "e": (9, [(1, "e")])}
    second = {"c": (3, [(8, "x"), (8, "y"), (1, None)])}
    third = {"c": (4, [(3, "x")]), "d": (5, [(4, "y")])}
    write_file_states(compute_states(rows_of(spark, first), SPEC, ["file_name", "day"]), names(spark, *first), path)
    write_file_states(
        compute_states(rows_of(spark, second), SPEC, ["file_name", "day"]), names(spark, "b", "c"), path, names(spark, "d", "e")
    )
    write_file_states(compute_states(rows_of(spark, third), SPEC, ["file_name", "day"]), names(spark, *third), path)
    return path, rows_of(spark, {"a": first["a"], "c": third["c"], "d": third["d"]})


def test_the_newest_state_of_a_file_counts(spark, values, stored):
    path, now = stored
    assert values(results_from_states(read_file_states(spark, path), SPEC)) == pytest.approx(values(profile(now, SPEC).results))


def test_windows_of_days(spark, values, stored, tmp_path):
    path, now = stored
    write_tree(tree_of_days(read_file_states(spark, path), "day", levels=2), str(tmp_path / "tree"))
    epoch = datetime.date(1970, 1, 1)
    for a, b in ((1, 5), (4, 4), (1, 4)):
        days = ((datetime.date(2024, 1, d) - epoch).days for d in (a, b))
        window = read_window(spark, str(tmp_path / "tree"), *days, levels=2)
        own = now.where(F.dayofmonth("day").between(a, b))
        assert values(results_from_states(window, SPEC)) == pytest.approx(values(profile(own, SPEC).results))


def test_a_replayed_batch_of_files_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = rows_of(spark, {"a": (1, [(1, "x")])})
    for _ in range(2):
        write_file_states(compute_states(rows, SPEC, ["file_name"]), names(spark, "a"), path, writer="w", batch=0)
    assert read_file_states(spark, path).scan.count() == 1


def test_nodes_of_windows():
    for first in range(20):
        for last in range(first - 1, 40):
            for levels in (0, 2, 6):
                nodes = nodes_of_window(first, last, levels)
                days = [d for level, n in nodes for d in range(n << level, (n + 1) << level)]
                assert sorted(days) == list(range(first, last + 1))
                assert levels < 6 or len(nodes) <= 2 * max(1, (last - first + 1).bit_length())


@pytest.fixture
def job(tmp_path):
    (tmp_path / "in").mkdir()
    return Job(
        location=str(tmp_path / "in"),
        metrics=size() + on("Sum", "id") + on("CountDistinct", "id"),
        manifest_path=str(tmp_path / "manifest"),
        metrics_path=str(tmp_path / "metrics"),
        bad_rows_path=str(tmp_path / "bad"),
        coerce_numeric=True,
    )


def kept(spark, job):
    return sorted((r.file_name, r.row) for r in read_rows(spark, job.bad_rows_path).collect())


def test_csv_rows_that_do_not_parse(spark, values, job, tmp_path):
    (tmp_path / "in" / "a.csv").write_text('id,x\n1,a\n2\n3,b,c\n4,"q,r"\n')
    (tmp_path / "in" / "wide.csv").write_text("id,x,y\n5,a,b\n6,a\n")
    (tmp_path / "in" / "good.csv").write_text("id,x\n9,a\n")
    assert run(spark, job) == 3
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert {f: found[f, "*", "BadRows"] for f in ("a.csv", "wide.csv", "good.csv")} == {"a.csv": 2, "wide.csv": 1, "good.csv": 0}
    assert {f: found[f, "*", "Size"] for f in ("a.csv", "wide.csv", "good.csv")} == {"a.csv": 2, "wide.csv": 1, "good.csv": 1}
    assert kept(spark, job) == [("a.csv", "2"), ("a.csv", "3,b,c"), ("wide.csv", "6,a")]


def test_json_rows_that_do_not_parse(spark, values, job, tmp_path):
    job.file_format = "json"
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n{"id": 2\n\n{"id": 3}\nnothing\n')
    (tmp_path / "in" / "b.json").write_text('{"id": 4, "more": "x"}\n')
    assert run(spark, job) == 2
    found = values(read_metrics(spark, job.metrics_path), "file_name")
    assert (found["a.json", "*", "Size"], found["a.json", "id", "Sum"], found["a.json", "*", "BadRows"]) == (2, 4, 2)
    assert (found["b.json", "*", "Size"], found["b.json", "*", "BadRows"]) == (1, 0)
    assert kept(spark, job) == [("a.json", "nothing"), ("a.json", '{"id": 2')]


RULES = compliance(["even", "named", "odd one"], ["i % 2 = 0", "s <> 'x'", "no_such > 1"])


def test_rows_by_the_rules_they_break(spark, values, reasons, tmp_path):
    df = spark.createDataFrame([(1, "x", 0), (2, "x", 1), (2, "y", 2), (None, None, 3)], "i int, s string, __rule0 int")
    found = write_split(df, RULES, str(tmp_path / "rows"))
    assert values(found)[("even", "Compliance")] == 0.5
    assert values(found)[("named", "Compliance")] == 0.25
    assert reasons(found)[("odd one", "Compliance")].startswith("predicate refused")
    want = values(profile(df, RULES).results)
    assert values(found) == want
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert sorted((r["__rule0"], r[BROKEN], r["broken"]) for r in rows.collect()) == [
        (0, ["even", "named"], "true"),
        (1, ["named"], "true"),
        (2, [], "false"),
        (3, ["even", "named"], "true"),
    ]


def test_verdicts_read_their_rows_once(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("i"), F.lit("y").alias("s")).write.parquet(str(tmp_path / "in"))
    verdicts = judge(spark.read.parquet(str(tmp_path / "in")), RULES)
    plan = verdicts.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match=BROKEN):
        judge(verdicts.rows, RULES)


def test_verdicts_without_rows_or_rules(spark, values, reasons):
    empty = judge(spark.createDataFrame([], "i int, s string"), RULES[:1])
    assert empty.rows.collect() == []
    assert reasons(empty.compliance()) == {("even", "Compliance"): "empty"}
    assert [r[BROKEN] for r in judge(spark.createDataFrame([(1,)], "i int"), []).rows.collect()] == [[]]
