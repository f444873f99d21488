import pytest
from pyspark.sql import functions as F

from tallygauge import approx_quantile, compliance, on, pairs, profile, size
from tallygauge.operators.states import compute_states, results_from_states
from tallygauge.streaming.incremental import read_states, write_states

SPEC = (
    size()
    + on("Completeness", "a,s")
    + on("Mean", "a")
    + on("Sum", "a")
    + on("Minimum", "a")
    + on("Maximum", "a")
    + on("DataType", "s")
    + on("CountDistinct", "a,s")
    + on("Entropy", "a,s")
    + on("Uniqueness", "a")
    + compliance("small", "a < 10")
    + pairs("Correlation", "a,b", "b,a")
    + pairs("MutualInformation", "a,s", "s,b")
)


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(500).select(
        (F.col("id") % 4).alias("file"),
        (F.col("id") % 3).alias("part"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 37).alias("a"),
        (1e6 + F.sqrt("id")).alias("b"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 6).cast("string")).alias("s"),
    )


@pytest.mark.parametrize("by", [[], ["part"]])
def test_merged_states_equal_a_profile_of_everything(spark, values, data, by):
    states = compute_states(data, SPEC, ["file", "part"])
    merged = values(results_from_states(states, SPEC, by), *by)
    assert merged == pytest.approx(values(profile(data, SPEC, by).results, *by), abs=1e-9)


def test_stored_states_grow_file_by_file(spark, values, data, tmp_path):
    path = str(tmp_path / "states")
    for file in range(4):
        part = data.where(F.col("file") == file)
        write_states(compute_states(part, SPEC, ["file"]), path, "w", file)
    # A replayed batch is known and not stored again.
    write_states(compute_states(data.where(F.col("file") == 3), SPEC, ["file"]), path, "w", 3)
    stored = read_states(spark, path, ("scan", "frequency", "joint"))
    merged = values(results_from_states(stored, SPEC))
    assert merged == pytest.approx(values(profile(data, SPEC).results), abs=1e-9)


def test_sketches_merge_within_their_error(spark, values):
    df = spark.range(60_000).select(
        (F.col("id") % 10).alias("file"),
        (F.col("id") % 20_000).alias("i"),
        (F.col("id") % 5_000).cast("double").alias("d"),
        (F.col("id") % 3_000).cast("string").alias("s"),
    )
    spec = on("ApproxCountDistinct", "i,d,s") + approx_quantile("d", 0.5)
    merged = values(results_from_states(compute_states(df, spec, ["file"]), spec))
    for column, exact in (("i", 20_000), ("d", 5_000), ("s", 3_000)):
        assert merged[(column, "ApproxCountDistinct")] == pytest.approx(exact, rel=0.05)
    assert merged[("d", "ApproxQuantile-0.5")] == pytest.approx(2_500, abs=150)


@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_estimates_do_not_depend_on_tasks_or_merging(spark, values, tasks):
    df = spark.range(0, 60_000, numPartitions=tasks).select(
        (F.col("id") % 7).alias("file"), (F.pmod(F.xxhash64("id"), F.lit(2_000))).alias("i")
    )
    spec = on("ApproxCountDistinct", "i")
    direct = values(profile(df, spec).metrics)
    assert direct == values(results_from_states(compute_states(df, spec, ["file"]), spec))
    assert direct == values(profile(df.coalesce(1), spec).metrics)


def test_sketches_of_all_null_columns(spark, values):
    df = spark.createDataFrame([(1, None), (2, None)], "file int, d double")
    spec = on("ApproxCountDistinct", "d") + approx_quantile("d", 0.5)
    merged = values(results_from_states(compute_states(df, spec, ["file"]), spec))
    assert merged == {("d", "ApproxCountDistinct"): 0, ("d", "ApproxQuantile-0.5"): None}


@pytest.mark.parametrize("stored", [False, True])
def test_refused_metrics_stay_refused(spark, data, reasons, tmp_path, stored):
    spec = size() + on("Mean", "s") + on("Entropy", "nothing,s")
    states = compute_states(data, spec, ["file"])
    if stored:
        write_states(states, str(tmp_path / "s"))
        states = read_states(spark, str(tmp_path / "s"), ("scan", "frequency"))
    failed = results_from_states(states, spec).where("value is null")
    assert reasons(failed) == {
        ("s", "Mean"): "column s is string, not numeric",
        ("nothing", "Entropy"): "unknown column nothing",
    }


def test_merged_correlation_of_constants_has_no_value(spark, tmp_path):
    sizes = {"a": 3, "b": 7, "c": 11, "d": 13, "e": 1}
    rows = [(g, float(i), c) for c in (0.1, 0.7, 1.1, 123.456) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x double, c double")
    spec = pairs("Correlation", "x", "c")
    states = compute_states(df, spec, ["c", "g"])
    found = results_from_states(states, spec, []).collect()
    assert found[0].value is not None
    for c in (0.1, 0.7, 1.1, 123.456):
        part = compute_states(df.where(F.col("c") == c), spec, ["g"])
        row = results_from_states(part, spec, []).first()
        assert (row.value, row.reason) == (None, "needs two rows and two varying columns")
