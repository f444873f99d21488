"""Learned bounds against plain Python, and runs checked one by one against the replay."""

import random
from math import sqrt

import pytest
from pyspark.sql import functions as F

from tallygauge.operators.learned import ADDED, SERIES, Learning, check_run, last_states, learned_bounds

SCHEMA = "grp string, entity string, instance string, name string, value double, run_date string"


def runs(n=30, seed=5):
    draw = random.Random(seed)
    rows = []
    for group, instance in (("a", "x"), (None, "x"), ("a", "y`1")):
        for i in range(n):
            value = draw.choice([None, float("nan")]) if draw.random() < 0.1 else draw.gauss(100, 5) + 20 * (i % 4)
            rows.append((group, "Column", instance, "Mean", value, f"2024-{i:03}"))
    draw.shuffle(rows)
    return rows


def plain(rows, learning):
    """Bounds by series and run from the formulas over plain lists."""
    found, series = {}, {}
    for r in sorted(rows, key=lambda r: r[5]):
        values, differences = series.setdefault(r[:4], ([], []))
        value = None if r[4] is None or r[4] != r[4] else r[4]
        base = 0.0 if not learning.season else values[-learning.season] if len(values) >= learning.season else None
        low = high = broken = None
        if len(differences) >= learning.warm_up and base is not None:
            mean, variance = differences[0], 0.0
            for d in differences[1:]:
                step = d - mean
                mean += learning.weight * step
                variance = (1 - learning.weight) * (variance + learning.weight * step * step)
            low, high = (base + mean + s * learning.spread * sqrt(variance) for s in (-1, 1))
            broken = None if value is None else not low - 1e-6 <= value <= high + 1e-6
        if value is not None and base is not None:
            differences.append(value - base)
        values.append(value)
        found[r[:4], r[5]] = (low, high, broken)
    return found


@pytest.mark.parametrize("learning", [Learning(), Learning(spread=1.0, season=4), Learning(weight=1.0, warm_up=1, season=1)])
def test_bounds_are_those_of_the_formulas(spark, learning):
    rows = runs()
    judged = learned_bounds(spark.createDataFrame(rows, SCHEMA).repartition(5), learning, by=["grp"]).collect()
    expected = plain(rows, learning)
    assert len(judged) == len(rows) == len(expected)
    for r in judged:
        low, high, broken = expected[(r.grp, r.entity, r.instance, r.name), r.run_date]
        assert (r.low, r.high) == (pytest.approx(low, abs=1e-6), pytest.approx(high, abs=1e-6)) if low is not None else r.low is None
        assert r.broken == broken
    if learning.spread == 1.0:
        assert {r.broken for r in judged} == {None, True, False}


@pytest.mark.parametrize("season", [0, 4])
def test_runs_one_by_one_are_the_replay(spark, season):
    learning = Learning(warm_up=2, spread=1.0, season=season)
    rows = runs(12)
    history = spark.createDataFrame(rows, SCHEMA)
    whole = learned_bounds(history, learning, by=["grp"])
    states = last_states(learned_bounds(history.where("run_date < '2024-008'"), learning, by=["grp"]), by=["grp"])
    key = ("grp", *SERIES)
    for day in range(8, 12):
        run = history.where(F.col("run_date") == f"2024-{day:03}")
        checked = check_run(states, run, learning, by=["grp"])
        shown = {tuple(r[k] for k in key): [r[c] for c in ADDED.names] for r in checked.collect()}
        replayed = whole.where(F.col("run_date") == f"2024-{day:03}").collect()
        for r in replayed:
            found, wanted = shown[tuple(r[k] for k in key)], [r[c] for c in ADDED.names]
            assert found[3:5] == wanted[3:5]
            for a, b in zip([*found[:3], *found[5:7], *found[7]], [*wanted[:3], *wanted[5:7], *wanted[7]], strict=True):
                assert a == (b if b is None else pytest.approx(b))
        states = spark.createDataFrame(checked.select(*key, *ADDED.names[4:]).collect(), checked.select(*key, *ADDED.names[4:]).schema)


def test_new_series_constant_series_and_no_rows(spark):
    constant = [("a", "Dataset", "*", "Size", 0.1, f"2024-{i:03}") for i in range(9)]
    history = spark.createDataFrame([*constant, ("a", "Dataset", "*", "Size", 0.2, "2024-009")], SCHEMA)
    broken = {r.run_date: r.broken for r in learned_bounds(history, by=["grp"]).collect()}
    assert broken == {f"2024-{i:03}": None if i < 5 else i == 9 for i in range(10)}
    empty = learned_bounds(history.limit(0), by=["grp"])
    assert empty.count() == 0
    first = check_run(last_states(empty, by=["grp"]), history.where("run_date = '2024-009'"), by=["grp"]).first()
    assert (first.broken, first.seen, first.mean) == (None, 1, 0.2)
    with pytest.raises(ValueError, match="expected"):
        learned_bounds(history.withColumn("expected", F.lit(1)))
    with pytest.raises(ValueError, match="weight"):
        Learning(weight=0)
