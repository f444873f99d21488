import base64
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallygauge.functions.columns import group_value
from tallygauge import (
    approx_quantile,
    compliance,
    on,
    pairs,
    pattern_match,
    profile,
    size,
)

ALL_FREQUENCY = ("CountDistinct", "Distinctness", "Entropy", "UniqueValueRatio", "Uniqueness")


def frequency(columns):
    return [m for kind in ALL_FREQUENCY for m in on(kind, columns)]


def everything(a="a", b="b"):
    return (
        size()
        + on("Completeness", a)
        + on("Mean", a)
        + on("Sum", a)
        + on("Minimum", a)
        + on("Maximum", a)
        + on("ApproxCountDistinct", a)
        + on("DataType", a)
        + approx_quantile(a, 0.5)
        + pattern_match(a, "^1")
        + compliance("rule", f"{a} > 1")
        + pairs("Correlation", a, b)
        + pairs("MutualInformation", a, b)
        + frequency(a)
    )


def test_frequencies_count_nulls_in_the_denominator_only(spark, values):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "u string")
    found = values(profile(df, frequency("u")).metrics)
    assert found[("u", "CountDistinct")] == 3
    assert found[("u", "Distinctness")] == pytest.approx(3 / 5)
    assert found[("u", "Uniqueness")] == pytest.approx(2 / 5)
    assert found[("u", "UniqueValueRatio")] == pytest.approx(2 / 3)
    entropy = -(2 / 5 * math.log(2 / 5) + 2 * (1 / 5 * math.log(1 / 5)))
    assert found[("u", "Entropy")] == pytest.approx(entropy)


def test_mutual_information_of_equal_columns_is_their_entropy(spark, values):
    df = spark.createDataFrame([("a", "x")] * 2 + [("b", "y")] * 2, "a string, b string")
    found = values(profile(df, pairs("MutualInformation", "a", "b") + on("Entropy", "a")).metrics)
    assert found[("a,b", "MutualInformation")] == pytest.approx(math.log(2))
    assert found[("a", "Entropy")] == pytest.approx(math.log(2))


def test_mutual_information_with_nulls(spark, values, reasons):
    rows = [("a", "x")] * 2 + [("b", "y")] * 2 + [("a", None), (None, "y")]
    df = spark.createDataFrame(rows, "a string, b string")
    found = values(profile(df, pairs("MutualInformation", "a", "b")).metrics)
    assert found[("a,b", "MutualInformation")] == pytest.approx(0.462098, abs=1e-6)
    apart = df.where("a is null or b is null")
    failed = reasons(profile(apart, pairs("MutualInformation", "a", "b")).failures)
    assert failed == {("a,b", "MutualInformation"): "no row has both values"}


def test_signed_zeros_and_nans_are_one_value_each(spark, values):
    nan = float("nan")
    df = spark.createDataFrame([(-0.0,), (0.0,), (nan,), (nan,)], "z double")
    for mapped in (df, df.withColumn("z", F.col("z").cast("float"))):
        found = values(profile(mapped, frequency("z")).metrics)
        assert found[("z", "CountDistinct")] == 2
        assert found[("z", "Uniqueness")] == 0


def test_empty_input(spark, values, reasons):
    df = spark.createDataFrame([], "a double, b double")
    result = profile(df, everything())
    assert values(result.metrics) == {
        ("*", "Size"): 0,
        ("a", "CountDistinct"): 0,
        ("a", "ApproxCountDistinct"): 0,
    }
    assert set(reasons(result.failures).values()) == {"empty"}
    # Every metric appears once in each result, DataType with eleven rows.
    assert result.results.count() == len(everything()) + 10


def test_one_row_and_constant_columns_have_no_correlation(spark, reasons):
    spec = pairs("Correlation", "a,b", "b,a")
    for rows in ([(1.0, 2.0)], [(0.1, 1.0), (0.1, 2.0), (0.1, 3.0)], [(1.0, None), (None, 2.0)]):
        df = spark.createDataFrame(rows, "a double, b double").repartition(3)
        failed = reasons(profile(df, spec).failures)
        assert set(failed.values()) == {"needs two rows and two varying columns"}
        assert len(failed) == 2


def test_correlation_keeps_digits_with_large_means(spark, values):
    rows = [(1e9 + i, 3e9 - i + (i % 3) * 0.5) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(8)
    found = values(profile(df, pairs("Correlation", "a", "b")).metrics)[("a,b", "Correlation")]
    # The same data without the offsets has the same correlation.
    small = df.select(F.col("a") - 1e9, F.col("b") - 3e9).toDF("a", "b").toPandas()
    assert found == pytest.approx(small["a"].corr(small["b"]), abs=1e-10)


def test_all_null_column_fails_with_a_reason(spark, values, reasons):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    result = profile(df, everything())
    found, failed = values(result.metrics), reasons(result.failures)
    assert found[("a", "Completeness")] == 0
    assert found[("a", "CountDistinct")] == 0
    assert found[("rule", "Compliance")] == 0
    assert failed[("a", "Mean")] == "no numbers"
    assert failed[("a", "UniqueValueRatio")] == "no non-null values"
    assert failed[("a,b", "MutualInformation")] == "no row has both values"


def test_datatype_classes_of_text(spark, values):
    cells = ["1", "-2", "+7", "3.5", ".5", "4.", "true", "false", "TRUE", "abc", "", "-", "12\n", None]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    found = values(profile(df, on("DataType", "v")).metrics)
    assert found[("v", "Histogram.bins")] == 5
    classes = {k[1].rsplit(".", 1)[1]: v for k, v in found.items() if "abs" in k[1]}
    assert classes == {"Unknown": 1, "Integral": 3, "Fractional": 3, "Boolean": 2, "String": 5}
    ratios = [v for k, v in found.items() if "ratio" in k[1]]
    assert sum(ratios) == pytest.approx(1)


def test_datatype_of_typed_columns_equals_that_of_their_text(spark, values):
    doubles = [0.0, -0.0, 1.5, 1e-3, 9.99e-4, 9999999.0, 1e7, -1e7, -0.5, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(d,) for d in doubles], "d double").select(
        "d",
        F.col("d").cast("float").alias("f"),
        F.lit(5).alias("i"),
        F.lit(True).alias("t"),
        F.lit("2024-01-01").cast("date").alias("day"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("at"),
        F.lit("1.50").cast("decimal(5,2)").alias("dec"),
    )
    names = df.columns
    typed = values(profile(df, on("DataType", names)).metrics)
    text = values(profile(df.select(*[F.col(n).cast("string").alias(n) for n in names]), on("DataType", names)).metrics)
    assert typed == text


def test_predicates_under_ansi(spark, values, reasons):
    df = spark.createDataFrame([("400", 1), ("x", 0), (None, 2), ("400", 0)], "press string, n int")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spec = compliance(
        ["text", "division", "in", "unknown", "number", "broken"],
        ["press = 400", "4 / n > 1", "n IN (1,2)", "nope > 1", "n + 1", "n >"],
    )
    result = profile(df, spec + on("Completeness", "press"))
    found, failed = values(result.metrics), reasons(result.failures)
    assert found[("text", "Compliance")] == 0.5
    assert found[("division", "Compliance")] == 0.5
    assert found[("in", "Compliance")] == 0.5
    assert "UNRESOLVED_COLUMN" in failed[("unknown", "Compliance")]
    assert failed[("number", "Compliance")] == "predicate is int, not boolean"
    assert "PARSE_SYNTAX_ERROR" in failed[("broken", "Compliance")]
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_text_columns_need_coercion_for_numbers(spark, values, reasons):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,)], "t string")
    spec = on("Mean", "t") + on("Sum", "t") + on("Maximum", "t")
    assert set(reasons(profile(df, spec).failures).values()) == {"column t is string, not numeric"}
    found = values(profile(df, spec, coerce_numeric=True).metrics)
    assert found == {("t", "Mean"): 1.75, ("t", "Sum"): 3.5, ("t", "Maximum"): 2.5}


def test_nested_columns_fail_where_they_must(spark, values, reasons):
    df = spark.createDataFrame([((1, "x"), [1, 2], {"k": 1})] * 2, "s struct<a:int,b:string>, l array<int>, m map<string,int>")
    spec = on("Completeness", "s,l,m") + on("CountDistinct", "s,l,m") + on("Mean", "s") + on("DataType", "l")
    result = profile(df, spec)
    found, failed = values(result.metrics), reasons(result.failures)
    assert [found[(c, "Completeness")] for c in "slm"] == [1, 1, 1]
    assert found[("s", "CountDistinct")] == found[("l", "CountDistinct")] == 1
    assert "cannot be grouped" in failed[("m", "CountDistinct")]
    assert "not numeric" in failed[("s", "Mean")]
    assert "not a plain value" in failed[("l", "DataType")]


def test_long_texts_are_counted_whole(spark, values):
    long = "x" * 5000
    digest = base64.b64encode(hashlib.sha256((long + "a").encode()).digest()).decode()
    rows = [long + "a", long + "b", long + "a", "x" * 50, "x" * 51, "é" * 25, "é" * 26, "sha256:" + digest]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    found = values(profile(df, frequency("t")).metrics)
    assert found[("t", "CountDistinct")] == 7
    assert found[("t", "Uniqueness")] == pytest.approx(6 / 8)
    (row,) = df.where("t = repeat('x', 51)").selectExpr(f"octet_length({group_value('t', df.schema['t'].dataType)}) AS n").collect()
    assert row.n == 51
    binary = df.select(F.col("t").cast("binary").alias("t"))
    assert values(profile(binary, frequency("t")).metrics) == found


def test_many_types_in_one_frequency_pass(spark, values):
    df = spark.createDataFrame([(1,), (2,), (2,)], "i int").select(
        "i",
        F.col("i").cast("bigint").alias("l"),
        F.col("i").cast("double").alias("d"),
        F.col("i").cast("string").alias("s"),
        F.col("i").cast("decimal(10,2)").alias("dec"),
        (F.col("i") > 1).alias("flag"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("day"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).cast("timestamp_ntz").alias("at"),
        F.struct("i").alias("nested"),
    )
    names = df.columns
    found = values(profile(df, frequency(names) + pairs("MutualInformation", "s,i,day", "dec,at,d")).metrics)
    for name in names:
        assert found[(name, "CountDistinct")] == 2
        assert found[(name, "Uniqueness")] == pytest.approx(1 / 3)
    entropy = found[("i", "Entropy")]
    for pair in ("s,dec", "i,at", "day,d"):
        assert found[(pair, "MutualInformation")] == pytest.approx(entropy)


def test_odd_column_names(spark, values):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "x", 3.0)], "`a.b` int, `we``ird, name` string, MiXed double")
    from tallygauge.spec import Metric

    odd = "we`ird, name"
    spec = [
        Metric("Mean", ("a.b",)),
        Metric("CountDistinct", (odd,)),
        Metric("Completeness", (odd,)),
        Metric("Sum", ("mixed",)),
        Metric("MutualInformation", ("a.b", odd)),
        Metric("DataType", (odd,)),
    ]
    result = profile(df, spec, by=[F.col("`a.b`").alias("g.h")])
    assert result.failures.count() == 0
    found = values(result.metrics, "g.h")
    assert found[(1, "a.b", "Mean")] == 1
    assert found[(2, odd, "CountDistinct")] == 1
    assert found[(2, "mixed", "Sum")] == 3


def test_grouped_result_is_the_result_of_each_group_alone(spark, values):
    rows = [("g1", i % 3, float(i % 4), None if i % 5 == 0 else str(i % 2)) for i in range(40)]
    rows += [("g2", 7, float(i), "z") for i in range(11)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "g string, a int, b double, c string")
    spec = everything() + frequency("b,c") + pairs("MutualInformation", "a", "c") + on("Completeness", "c")
    grouped = profile(df, spec, ["g"])
    found = values(grouped.results, "g")
    for group in ("g1", "g2", None):
        alone = values(profile(df.where(F.col("g").eqNullSafe(F.lit(group))), spec).results)
        assert {k[1:]: v for k, v in found.items() if k[0] == group} == pytest.approx(alone)


def test_listed_groups_without_data_are_reported_as_empty(spark, values, reasons):
    df = spark.createDataFrame([("g1", 1.0, 2.0)], "g string, a double, b double")
    groups = spark.createDataFrame([("g1",), ("g2",)], "g string")
    result = profile(df, everything(), ["g"], groups=groups)
    found = {k: v for k, v in values(result.metrics, "g").items() if k[0] == "g2"}
    assert found == {("g2", "*", "Size"): 0, ("g2", "a", "CountDistinct"): 0, ("g2", "a", "ApproxCountDistinct"): 0}
    failed = {k: v for k, v in reasons(result.failures, "g").items() if k[0] == "g2"}
    assert set(failed.values()) == {"empty"}
    assert len(failed) + len(found) == len(everything()) + 10


def test_grouping_columns_may_not_hide_result_columns(spark):
    df = spark.createDataFrame([("x",)], "name string")
    with pytest.raises(ValueError, match="name"):
        profile(df, size(), ["name"])


def test_sums_of_large_integers_do_not_overflow(spark, values):
    df = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "n bigint")
    found = values(profile(df, on("Sum", "n") + on("Mean", "n")).metrics)
    assert found[("n", "Sum")] == pytest.approx(3 * 2.0**62)
    assert found[("n", "Mean")] == pytest.approx(2.0**62)


def test_unknown_columns_do_not_stop_the_rest(spark, values, reasons):
    df = spark.createDataFrame([(1,), (3,)], "a int")
    result = profile(df, on("Mean", "a,zz") + pairs("Correlation", "a", "zz"))
    assert values(result.metrics) == {("a", "Mean"): 2.0}
    assert reasons(result.failures) == {
        ("zz", "Mean"): "unknown column zz",
        ("a,zz", "Correlation"): "unknown column zz",
    }


def test_approximate_metrics_stay_within_their_error(spark, values):
    df = spark.range(0, 50_000).select((F.col("id") % 20_000).alias("v"), (F.col("id") % 100).cast("double").alias("q"))
    found = values(profile(df, on("ApproxCountDistinct", "v") + approx_quantile("q", 0.25)).metrics)
    assert abs(found[("v", "ApproxCountDistinct")] - 20_000) <= 0.15 * 20_000
    assert abs(found[("q", "ApproxQuantile-0.25")] - 24.5) <= 1.5


def test_grouping_columns_may_have_common_names(spark, values):
    names = ["column", "pair", "copies", "rows", "both", "side", "value_x", "a_x", "b_x", "distinct"]
    df = spark.createDataFrame([(*range(10), "u", "v")] * 3, [*names, "x", "y"])
    spec = size() + frequency("x") + pairs("MutualInformation", "x", "y")
    found = values(profile(df, spec, names).metrics, *names)
    assert found[(*range(10), "x", "CountDistinct")] == 1
    assert found[(*range(10), "x,y", "MutualInformation")] == 0
    assert len(found) == 7


def test_refused_patterns_and_predicates_stop_nothing(spark, reasons, values):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0)], "t string, v double")
    rules = {
        "window": "row_number() OVER (ORDER BY v) < 5",
        "subquery": "v > (SELECT 1)",
        "in": "v IN (SELECT 1)",
        "sum": "sum(v) > 1",
        "ok": "v > 1",
    }
    spec = pattern_match("t", "[") + compliance(list(rules), list(rules.values())) + size()
    found = profile(df, spec)
    assert values(found.metrics) == {("*", "Size"): 2.0, ("ok", "Compliance"): 0.5}
    why = reasons(found.failures)
    assert why[("t", "PatternMatch")].startswith("pattern refused")
    assert {why[(k, "Compliance")] for k in ("window", "subquery", "in")} == {"predicate looks beyond its row"}


def test_listed_groups_only_add(spark, values):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, None), ("b", 1)], "t string, v bigint")
    listed = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "t string")
    spec = size() + on("CountDistinct", "v")
    found = values(profile(df, spec, ["t"], groups=listed).metrics, "t")
    assert {k[0]: v for k, v in found.items() if k[2] == "Size"} == {"a": 1, "b": 1, None: 2, "z": 0}
    assert {k[0]: v for k, v in found.items() if k[2] != "Size"} == {"a": 1, "b": 1, None: 1, "z": 0}


def test_collated_texts_are_one_value_where_they_are_equal(spark, values):
    df = spark.createDataFrame([("a",), ("A",), ("b",)], "t string").selectExpr("t COLLATE UTF8_LCASE AS t")
    found = values(profile(df, on("CountDistinct", "t") + on("ApproxCountDistinct", "t")).metrics)
    assert found == {("t", "CountDistinct"): 2.0, ("t", "ApproxCountDistinct"): 2.0}
