"""Metrics over time: every run is kept under its date and tags, and each value can be read next to one before.

Runs are rows of a stored table: a run that is stored again hides the one before as a whole, from the moment its commit is there,
and a reader in between finds the old one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygauge.functions.columns import quoted
from tallygauge.sources.tables import ROWS, VERSION, compact_tables, read_rows, write_rows

RUN, TAGS = "run_date", "tags"
SERIES = ("entity", "instance", "name")
MARK = "__run"


def tag_text(tags: Mapping[str, str] | None) -> str:
    """Tags as one text, the same for equal tags in any order."""
    return json.dumps({str(k): str(v) for k, v in (tags or {}).items()}, sort_keys=True, ensure_ascii=False)


def append_run(metrics: DataFrame, path: str, run_date: str, tags: Mapping[str, str] | None = None) -> None:
    """Store one run under its date and tags; storing the same again replaces it, also by a run without rows."""
    if clash := {RUN, TAGS, MARK} & set(metrics.columns):
        raise ValueError(f"a run cannot have a column {sorted(clash)}")
    marker = metrics.sparkSession.range(1).select(F.lit(True).alias(MARK))
    rows = metrics.withColumn(MARK, F.lit(False)).unionByName(marker, allowMissingColumns=True)
    write_rows(rows.withColumns({RUN: F.lit(run_date).cast("date"), TAGS: F.lit(tag_text(tags))}), path)


def newest_runs(rows: DataFrame) -> DataFrame:
    newest = rows.groupBy(RUN, TAGS).agg(F.max(VERSION).alias(VERSION))
    return rows.join(newest, [RUN, TAGS, VERSION])


def read_history(spark: SparkSession, path: str, tags: Mapping[str, str] | None = None) -> DataFrame:
    """All runs, each as it was stored last; with ``tags`` those that have all of them, among others."""
    rows = newest_runs(read_rows(spark, path)).where(~F.col(MARK)).drop(MARK, VERSION)
    own = F.from_json(TAGS, "map<string,string>")
    for name, value in (tags or {}).items():
        rows = rows.where(own[F.lit(str(name))] == str(value))
    return rows


def keep_runs(spark: SparkSession, path: str, newest: int) -> None:
    """Let go of all but the ``newest`` runs of every set of tags, and of runs that were replaced."""

    def kept(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(TAGS).orderBy(F.desc(RUN))
        dates = rows.select(RUN, TAGS).distinct().withColumn("__place", F.row_number().over(order))
        chosen = dates.where(F.col("__place") <= newest).drop("__place")
        return newest_runs(rows).join(chosen, [RUN, TAGS], "left_semi")

    compact_tables(spark, path, {ROWS: kept})


def with_change(history: DataFrame, order: str = RUN, by: Iterable[str] = ()) -> DataFrame:
    """Add the value of the run before and the change since, per group and metric, among runs of equal tags.

    A window holds one row per run of one metric, never data rows.
    """
    tags = [TAGS] if TAGS in history.columns and TAGS not in by else []
    keys = [*map(quoted, [*tags, *by]), *SERIES]
    previous = F.lag("value").over(Window.partitionBy(*keys).orderBy(quoted(order)))
    return with_ratio(history.withColumn("previous", previous), "previous")


def with_ratio(rows: DataFrame, other: str) -> DataFrame:
    return rows.withColumns(
        {"change": F.col("value") - F.col(other), "ratio": F.try_divide(F.col("value"), F.col(other))}
    )


def as_of(
    history: DataFrame,
    reference: DataFrame,
    within: int | None = None,
    same_date: bool = True,
    order: str = RUN,
    by: Iterable[str] = (),
) -> DataFrame:
    """Add the value that ``reference`` had last, as ``baseline`` of ``baseline_run``, and the change since.

    For every metric of a run this is the reference's newest run that has the metric, on the same date (unless ``same_date`` is off) or
    before, at most ``within`` days ago. Of several values of one date the largest counts; null values are passed over.

    Both sides are put in order together, one row per run of a metric; nothing is joined by a range.
    """
    if clash := {"baseline", "baseline_run", "change", "ratio"} & set(history.columns):
        raise ValueError(f"a history cannot have a column {sorted(clash)}")
    keys = [*by, *SERIES]
    named = [F.col(quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)]
    when, value = F.col(quoted(order)).alias("__when"), F.col("value").cast("double").alias("__value")
    own = history.select(*named, when, F.lit(1).alias("__side"), F.struct("*").alias("__row"))
    place = F.lit(0 if same_date else 2).alias("__side")
    other = reference.where("value IS NOT NULL").select(*named, when, place, value)
    both = own.unionByName(other, allowMissingColumns=True)
    line = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__when", "__side", "__value")
    seen = F.when(F.col("__side") != 1, F.struct("__value", "__when"))
    found = both.withColumn("__last", F.last(seen, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.where(F.col("__side") == 1)
    if within is not None:
        recent = F.date_diff("__when", F.col("__last")["__when"]) <= within
        found = found.withColumn("__last", F.when(recent, F.col("__last")))
    rows = found.select(
        "__row.*", F.col("__last")["__value"].alias("baseline"), F.col("__last")["__when"].alias("baseline_run")
    )
    return with_ratio(rows, "baseline")
