"""The shape of the physical plans: what is read, what is shuffled, what is not there."""

import re

import pytest
from pyspark.sql import functions as F

from tallygauge import compliance, on, pairs, profile, size

FREQUENCY = ("CountDistinct", "Distinctness", "Entropy", "UniqueValueRatio", "Uniqueness")


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.range(1000).selectExpr(
        "id", "id % 7 as k", "cast(id % 5 as string) as s", "cast(id as double) as d", "'unused' as u"
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_scan_metrics_share_one_pass_and_one_shuffle(rows):
    spec = (
        size()
        + on("Completeness", "k,s,d")
        + on("Mean", "k,d")
        + on("Sum", "d")
        + on("ApproxCountDistinct", "s,d")
        + on("DataType", "s")
        + compliance("big", "d > 10")
        + pairs("Correlation", "k", "d")
    )
    plan = plan_of(profile(rows, spec, ["k"]).metrics)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "partial_count" in plan
    assert "Join" not in plan and "Python" not in plan
    assert "u:string" not in plan


def test_datatype_patterns_run_once_per_cell(rows):
    plan = plan_of(profile(rows, on("DataType", "s"), ["k"]).metrics)
    assert plan.count(r"^[-+]?\d+\z") == 1


def test_frequency_metrics_of_all_columns_share_one_pass(rows):
    spec = [m for kind in FREQUENCY for m in on(kind, "id,s,d")]
    plan = plan_of(profile(rows, spec, ["k"]).metrics)
    # One scan counts values of all columns and types; the scan pass has nothing to do.
    assert plan.count("FileScan") == 1
    assert plan.count("Expand") == 1
    assert plan.count("Exchange") == 2
    first = plan.rindex("partial_count(1)")
    assert first > plan.rindex("Exchange"), "counting starts before the shuffle"
    assert "Join" not in plan and "Window" not in plan


def test_mutual_information_reads_the_data_once_without_joins(rows):
    spec = pairs("MutualInformation", "id,s", "s,d")
    plan = plan_of(profile(rows, spec, ["k"]).metrics)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 3
    assert not re.search("Join|Window|Cartesian", plan)


def test_a_full_profile_takes_three_scans(rows):
    spec = (
        size()
        + on("Mean", "d")
        + [m for kind in FREQUENCY for m in on(kind, "id,s,d")]
        + pairs("MutualInformation", "s", "d")
    )
    plan = plan_of(profile(rows, spec, ["k"]).metrics)
    assert plan.count("FileScan") == 3
    assert not re.search("Join|Window|Python|Broadcast", plan)


def test_texts_of_every_length_are_counted_as_they_are(rows):
    plan = plan_of(profile(rows, on("Entropy", "s")).metrics)
    assert not re.search("sha2|octet_length", plan)


def test_filters_before_a_profile_reach_the_scan(rows):
    plan = plan_of(profile(rows.where(F.col("d") > 10), on("Mean", "d"), ["k"]).metrics)
    assert "GreaterThan(d,10.0)" in plan


def test_wide_tables_stay_in_generated_code(spark, tmp_path, values):
    names = [f"c{i}" for i in range(60)]
    path = str(tmp_path / "wide")
    spark.range(50).selectExpr("id % 2 as g", *[f"id + {i} as {n}" for i, n in enumerate(names)]).write.parquet(path)
    wide = spark.read.parquet(path)
    spec = size() + [m for k in ("Completeness", "Mean", "Minimum", "Maximum") for m in on(k, names)]
    result = profile(wide, spec + on("ApproxCountDistinct", "c0"), ["g"])
    plan = plan_of(result.results)
    assert plan.count("FileScan") == 4
    found = values(result.results, "g")
    assert len(found) == 2 * (1 + 4 * 60 + 1)
    assert found[(0, "c7", "Mean")] == 24 + 7 and found[(1, "c59", "Maximum")] == 49 + 59
