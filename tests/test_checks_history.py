import pytest
from pyspark.sql import functions as F

from tallygauge import on, profile, size
from tallygauge.operators.checks import Constraint, check_status, verify
from tallygauge.operators.history import append_run, as_of, keep_runs, read_history, with_change


@pytest.fixture
def results(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g1", 3.0), ("g2", 10.0)], "g string, v double")
    spec = size() + on("Mean", "v,missing")
    return profile(df, spec, ["g"]).results, spec


@pytest.mark.parametrize("static", [True, False])
def test_constraints_have_statuses(results, static):
    frame, spec = results
    rules = [
        Constraint("*", "Size", low=2),
        Constraint("v", "Mean", low=0, high=5, level="Warning"),
        Constraint("missing", "Mean", low=0),
        Constraint("v", "Sum", low=0),
    ]
    found = verify(frame, rules, ["g"], spec if static else None)
    rows = {(r.g, r.instance, r.name): (r.status, r.message) for r in found.collect()}
    assert rows == {
        ("g1", "*", "Size"): ("Success", None),
        ("g2", "*", "Size"): ("Error", "value out of bounds"),
        ("g1", "v", "Mean"): ("Success", None),
        ("g2", "v", "Mean"): ("Warning", "value out of bounds"),
        ("g1", "missing", "Mean"): ("Error", "unknown column missing"),
        ("g2", "missing", "Mean"): ("Error", "unknown column missing"),
        (None, "v", "Sum"): ("Error", "metric not computed"),
    }
    worst = {r.g: (r.status, r.failed) for r in check_status(found, ["g"]).collect()}
    assert worst == {"g1": ("Error", 1), "g2": ("Error", 3), None: ("Error", 1)}


def test_checks_on_metrics_without_reasons(spark, results):
    frame, _ = results
    found = verify(frame.where("value is not null").drop("reason"), [Constraint("*", "Size", high=1)], ["g"])
    assert {r.g: r.status for r in found.collect()} == {"g1": "Error", "g2": "Success"}


def test_constraints_are_validated():
    with pytest.raises(ValueError, match="bound"):
        Constraint("*", "Size")
    with pytest.raises(ValueError, match="level"):
        Constraint("*", "Size", low=1, level="Info")


def test_history_keeps_runs_and_shows_changes(spark, tmp_path):
    path = str(tmp_path / "history")
    for date, n in (("2024-01-01", 10), ("2024-01-02", 15), ("2024-01-02", 20), ("2024-01-03", 0)):
        append_run(profile(spark.range(n), size() + on("Mean", "id")).metrics, path, date)
    rows = with_change(read_history(spark, path)).where("name = 'Size'").orderBy("run_date").collect()
    assert [(str(r.run_date), r.value, r.previous, r.change, r.ratio) for r in rows] == [
        ("2024-01-01", 10, None, None, None),
        ("2024-01-02", 20, 10, 10, 2),
        ("2024-01-03", 0, 20, -20, 0),
    ]


def run(spark, value, instance="v"):
    return spark.createDataFrame([("Column", instance, "Mean", value)], "entity string, instance string, name string, value double")


def test_runs_are_kept_by_tags_and_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "history")
    prod, test = {"env": "prod", "team": 'a"b'}, {"env": "test"}
    for date, tags, value in (("2024-01-01", prod, 1.0), ("2024-01-01", test, 9.0), ("2024-01-03", dict(reversed(prod.items())), 3.0)):
        append_run(run(spark, value), path, date, tags)
    changed = {(str(r.run_date), r.value): r.previous for r in with_change(read_history(spark, path)).collect()}
    assert changed == {("2024-01-01", 1.0): None, ("2024-01-01", 9.0): None, ("2024-01-03", 3.0): 1.0}
    assert [r.value for r in read_history(spark, path, {"team": 'a"b'}).orderBy("run_date").collect()] == [1.0, 3.0]
    # Replaced by a run without rows, which hides the old rows too, before and after the old are let go.
    append_run(run(spark, 0.0).limit(0), path, "2024-01-03", prod)
    append_run(run(spark, 8.0, "w"), path, "2024-01-02", test)
    for _ in range(2):
        found = {(str(r.run_date), r.instance, r.value) for r in read_history(spark, path).collect()}
        assert found == {("2024-01-01", "v", 1.0), ("2024-01-01", "v", 9.0), ("2024-01-02", "w", 8.0)}
        keep_runs(spark, path, 2)
    keep_runs(spark, path, 1)
    append_run(run(spark, 7.0), path, "2024-01-04", test)
    keep_runs(spark, path, 1)
    assert [(str(r.run_date), r.value) for r in read_history(spark, path).collect()] == [("2024-01-04", 7.0)]


def test_values_as_of_another_series(spark):
    schema = "run_date date, entity string, instance string, name string, value double, extra int"

    def series(*days):
        rows = [(f"2024-01-{d:02}", "Column", i, "Mean", v, 5) for d, i, v in days]
        return spark.createDataFrame(rows, schema.replace("date date", "date string")).withColumn("run_date", F.col("run_date").cast("date"))

    own = series((2, "a", 10.0), (5, "a", None), (9, "a", 30.0), (9, "b", 1.0), (1, None, 4.0))
    other = series((2, "a", 1.0), (2, "a", 2.0), (4, "a", None), (8, "b", 7.0), (9, "a", 5.0), (1, None, 2.0))

    def found(**more):
        rows = as_of(own, other, **more).collect()
        assert {r.extra for r in rows} == {5}
        return {(r.run_date.day, r.instance): (r.baseline, r.baseline_run and r.baseline_run.day, r.ratio) for r in rows}

    assert found() == {
        (2, "a"): (2.0, 2, 5.0), (5, "a"): (2.0, 2, None), (9, "a"): (5.0, 9, 6.0), (9, "b"): (7.0, 8, 1 / 7), (1, None): (2.0, 1, 2.0)
    }
    nothing = (None, None, None)
    assert found(same_date=False, within=3) == {
        (2, "a"): nothing, (5, "a"): (2.0, 2, None), (9, "a"): nothing, (9, "b"): (7.0, 8, 1 / 7), (1, None): nothing
    }


def test_constraints_travel_to_the_results(results):
    frame, spec = results
    found = verify(frame, [Constraint("*", "Size", low=2)], ["g"], spec)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_nan_is_within_no_bounds(spark):
    results = spark.createDataFrame([("x", "Mean", float("nan"))], "instance string, name string, value double")
    found = verify(results, [Constraint("x", "Mean", low=0)]).first()
    assert (found.constraint_status, found.message) == ("Failure", "value out of bounds")
