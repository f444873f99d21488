"""Samples of values against exact counts, and merged samples against one pass."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallygauge import on
from tallygauge.operators import samples
from tallygauge.operators.samples import SAMPLED, merge_sample_states, sample_results, sample_states
from tallygauge.plans.profile import profile

SPEC = [m for kind in SAMPLED for m in on(kind, "a,b")]
K = 64


def keyed(df, *by):
    return {tuple(r[c] for c in (*by, "instance", "name")): (r.value, r.low, r.high) for r in df.collect()}


def data(spark, n=6000, seed=3):
    draw = random.Random(seed)
    rows = [
        (draw.choice(["x", "y", None]), draw.randrange(7), draw.randrange(900), draw.choice([None, 0.0, -0.0, float("nan"), 2.5]))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "g string, day int, a int, b double")


def test_few_values_are_counted_exactly(spark, values):
    _, df = data(spark, 500)
    found = keyed(sample_results(sample_states(df, SPEC, ["g"]), SPEC, ["g"]), "g")
    assert all(v == low == high for v, low, high in found.values())
    exact = values(profile(df, SPEC, ["g"]).results, "g")
    assert {k: v for k, (v, _, _) in found.items()} == pytest.approx(exact)


def test_merged_samples_are_the_sample_of_all_rows(spark, monkeypatch):
    rows, df = data(spark)
    direct = {tuple(r) for r in sample_states(df.coalesce(1), SPEC, ["g"], K).collect()}
    daily = sample_states(df.repartition(7), SPEC, ["g", "day"], K)
    assert {tuple(r) for r in merge_sample_states(daily, ["g"], K).collect()} == direct
    # Copies of kept values are those of all rows, and the totals are under the null hash.
    whole = df.where("a IS NOT NULL").groupBy("g", F.xxhash64(F.col("a").cast("bigint")).alias("h")).count()
    counts = {(r.g, r.h): r["count"] for r in whole.collect()}
    kept = {(r[0], r[2]): r[3] for r in direct if r[1] == "a" and r[2] is not None}
    for group in ("x", "y", None):
        hashes = sorted(h for g, h in counts if g == group)[:K]
        assert {h: c for (g, h), c in kept.items() if g == group} == {h: counts[group, h] for h in hashes}
    sizes = Counter(r[0] for r in rows)
    assert {r[0]: r[3] for r in direct if r[1] == "a" and r[2] is None} == sizes


def test_tasks_that_hand_on_early_change_nothing(spark):
    _, df = data(spark)
    direct = {tuple(r) for r in sample_states(df, SPEC, (), K).collect()}
    part = samples.partial_samples([], {"a": "h0"}, K)
    hashed = df.select(F.xxhash64(F.col("a").cast("bigint")).alias("h0")).toArrow()
    pieces = [b.to_pylist() for i in range(0, 6000, 500) for b in part(iter(hashed.slice(i, 500).combine_chunks().to_batches()))]
    added = Counter()
    for piece in pieces:
        for row in piece:
            if row[samples.HASH] is not None:
                added[row[samples.HASH]] += row[samples.COPIES]
    expected = {r[1]: r[2] for r in direct if r[0] == "a" and r[1] is not None}
    assert {h: added[h] for h in sorted(added)[:K]} == expected


@pytest.mark.parametrize("seed", range(3))
def test_exact_values_are_inside_the_bounds(spark, values, seed):
    ids = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 500 + seed * 7919).otherwise(F.col("id") * 31 + seed).alias("a"),
        F.concat(F.lit(f"v{seed}-"), F.col("id") % 700).alias("b"),
    )
    found = keyed(sample_results(sample_states(ids, SPEC, (), 256), SPEC, (), 256))
    for key, exact in values(profile(ids, SPEC).results).items():
        value, low, high = found[key]
        assert low <= exact <= high and low <= value <= high, key
    value, low, high = found["a", "CountDistinct"]
    assert high - low < 0.6 * value


def test_no_rows_and_only_nulls(spark):
    empty = spark.createDataFrame([], "a int, b string")
    found = keyed(sample_results(sample_states(empty, SPEC), SPEC))
    assert found["a", "CountDistinct"] == (0, 0, 0) and found["b", "Distinctness"] == (None, None, None)
    nulls = spark.createDataFrame([(None, None)] * 3, "a int, b string")
    found = keyed(sample_results(sample_states(nulls, SPEC), SPEC))
    assert found["a", "CountDistinct"] == (0, 0, 0) and found["a", "Distinctness"] == (0, 0, 0)
    assert found["a", "UniqueValueRatio"] == (None, None, None)


def test_smaller_samples_cannot_become_larger_ones(spark):
    _, df = data(spark, 100)
    states = sample_states(df, SPEC, (), K)
    with pytest.raises(Exception, match="fewer than 128"):
        merge_sample_states(states, [], 128).collect()
    with pytest.raises(ValueError, match="Entropy of a"):
        sample_states(df, on("Entropy", "a"))


def test_collated_texts_are_refused_and_cuts_are_made_before_the_shuffle(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",)], "a string")
    with pytest.raises(ValueError, match="collation"):
        sample_states(df.selectExpr("a COLLATE UTF8_LCASE AS a"), on("CountDistinct", "a"))
    plan = sample_states(df, on("CountDistinct", "a"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BatchEvalPython" not in plan
