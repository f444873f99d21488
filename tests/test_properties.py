"""Random small tables against plain Python, and the relations that always hold."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallygauge import on, pairs, profile, size
from tallygauge.operators.states import compute_states, results_from_states

cell = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "", "d" * 70, "d" * 71]))
number = st.one_of(st.none(), st.integers(-3, 3).map(float), st.just(-0.0))
row = st.tuples(st.sampled_from(["p", "q", None]), cell, number)

KINDS = ("CountDistinct", "Distinctness", "Entropy", "UniqueValueRatio", "Uniqueness")
SPEC = (
    size()
    + on("Completeness", "x,y")
    + on("Sum", "y")
    + [m for k in KINDS for m in on(k, "x,y")]
    + pairs("MutualInformation", "x,x", "y,x")
    + pairs("Correlation", "y", "y")
)
SCHEMA = "part string, x string, y double"


def expected(rows):
    """The metrics of one group from their definitions; None where there is no value."""
    n = len(rows)
    out = {("*", "Size"): n}
    for i, name in ((1, "x"), (2, "y")):
        cells = [r[i] for r in rows if r[i] is not None]
        counts = Counter(cells)
        once = sum(1 for c in counts.values() if c == 1)
        out[(name, "Completeness")] = len(cells) / n if n else None
        out[(name, "CountDistinct")] = len(counts)
        out[(name, "Distinctness")] = len(counts) / n if n else None
        out[(name, "Uniqueness")] = once / n if cells else None
        out[(name, "UniqueValueRatio")] = once / len(counts) if counts else None
        out[(name, "Entropy")] = (
            -sum(c / n * math.log(c / n) for c in counts.values()) if counts else None
        )
    numbers = [r[2] for r in rows if r[2] is not None]
    out[("y", "Sum")] = sum(numbers) if numbers else None
    out[("y,y", "Correlation")] = 1.0 if len(set(numbers)) > 1 else None
    for a, b, key in ((1, 2, "x,y"), (1, 1, "x,x")):
        joint = Counter((r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None)
        left, right = Counter(r[a] for r in rows), Counter(r[b] for r in rows)
        out[(key, "MutualInformation")] = (
            sum(c / n * math.log((c / n) / (left[k[0]] / n * right[k[1]] / n)) for k, c in joint.items())
            if joint
            else None
        )
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, max_size=25))
def test_metrics_match_their_definitions(spark, values, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = values(profile(df, SPEC).results)
    for key, value in expected(rows).items():
        if key[1] == "Uniqueness" and value is None and rows:
            value = 0
        assert found[key] == (pytest.approx(value, abs=1e-9) if value is not None else None), key

    for column in ("x", "y"):
        unique, distinct, complete = (found[(column, k)] for k in ("Uniqueness", "Distinctness", "Completeness"))
        if rows:
            assert 0 <= unique <= distinct <= complete <= 1
        if found[(column, "Entropy")] is not None:
            assert found[(column, "UniqueValueRatio")] == pytest.approx(unique / distinct)
            if complete == 1:
                assert found[(column, "Entropy")] <= math.log(found[(column, "CountDistinct")]) + 1e-9
    if found[("x", "Entropy")] is not None:
        assert found[("x,x", "MutualInformation")] == pytest.approx(found[("x", "Entropy")], abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_groups_and_merged_states_match_the_definitions(spark, values, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    grouped = values(profile(df, SPEC, ["part"]).results, "part")
    merged = values(results_from_states(compute_states(df, SPEC, ["part", "x"]), SPEC, ["part"]), "part")
    for part in {r[0] for r in rows}:
        for key, value in expected([r for r in rows if r[0] == part]).items():
            if key[1] == "Uniqueness" and value is None:
                value = 0
            want = pytest.approx(value, abs=1e-9) if value is not None else None
            assert grouped[(part, *key)] == want, key
            assert merged[(part, *key)] == want, key
