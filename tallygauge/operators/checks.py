"""Constraints on metrics: which groups pass, warn or fail."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygauge.functions.columns import quoted
from tallygauge.functions.local import local_table
from tallygauge.spec import Metric

LEVELS = ("Error", "Warning")


@dataclass(frozen=True)
class Constraint:
    """``low <= value <= high`` for one metric; a missing metric fails the constraint."""

    instance: str
    name: str
    low: float | None = None
    high: float | None = None
    level: str = "Error"
    check: str = "quality"

    def __post_init__(self) -> None:
        if self.level not in LEVELS:
            raise ValueError(f"level is one of {LEVELS}, got {self.level!r}")
        if self.low is None and self.high is None:
            raise ValueError("a constraint needs a lower or an upper bound")


def verify(
    results: DataFrame,
    constraints: Iterable[Constraint],
    by: Iterable[str] = (),
    metrics: Iterable[Metric] | None = None,
) -> DataFrame:
    """One row per group and constraint with ``constraint_status`` Success or Failure.

    ``status`` is what the constraint says about its group: Success, or its level when it
    fails. Constraints on metrics nobody asked for come out once, with no group; they are
    found from ``metrics`` if given, else by a second look at ``results``.
    """
    by, constraints = list(by), list(constraints)
    wanted = constraint_table(results.sparkSession, constraints)
    if "reason" not in results.columns:
        results = results.withColumn("reason", F.lit(None).cast("string"))
    # The constraints are a local table of known size, so Spark ships them to the results and
    # the many rows of one metric stay where they are.
    tested = results.join(wanted, ["instance", "name"])
    if metrics is None:
        seen = results.select("instance", "name").distinct()
        unmeasured = wanted.join(seen, ["instance", "name"], "left_anti")
    else:
        asked = {(m.instance, m.name) for m in metrics}
        bins = {m.instance for m in metrics if m.kind == "DataType"}
        rest = [
            c
            for c in constraints
            if (c.instance, c.name) not in asked
            and not (c.instance in bins and c.name.startswith("Histogram."))
        ]
        unmeasured = constraint_table(results.sparkSession, rest) if rest else None
    if unmeasured is not None:
        tested = tested.unionByName(unmeasured, allowMissingColumns=True)
    value = F.col("value")
    # NaN is above every number for Spark, and within no bounds.
    number = value.isNotNull() & ~F.isnan(value)
    above = F.col("low").isNull() | (value >= F.col("low"))
    below = F.col("high").isNull() | (value <= F.col("high"))
    met = F.coalesce(number & above & below, F.lit(False))
    return tested.select(
        *map(quoted, by),
        "check",
        "level",
        "instance",
        "name",
        "low",
        "high",
        "value",
        F.when(met, "Success").otherwise("Failure").alias("constraint_status"),
        F.when(met, "Success").otherwise(F.col("level")).alias("status"),
        F.when(value.isNull(), F.coalesce("reason", F.lit("metric not computed")))
        .when(~met, "value out of bounds")
        .alias("message"),
    )


def constraint_table(spark: SparkSession, constraints: Iterable[Constraint]) -> DataFrame:
    schema = "`check` string, instance string, name string, low double, high double, level string"
    rows = [
        (
            c.check,
            c.instance,
            c.name,
            None if c.low is None else float(c.low),
            None if c.high is None else float(c.high),
            c.level,
        )
        for c in constraints
    ]
    return local_table(spark, schema, rows)


def check_status(verified: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The worst status of each group and check."""
    rank = F.when(F.col("status") == "Error", 2).when(F.col("status") == "Warning", 1).otherwise(0)
    worst = F.max(rank)
    return verified.groupBy(*map(quoted, by), "check").agg(
        F.when(worst == 2, "Error").when(worst == 1, "Warning").otherwise("Success").alias("status"),
        F.count_if(F.col("constraint_status") == "Failure").alias("failed"),
        F.count(F.lit(1)).alias("constraints"),
    )
