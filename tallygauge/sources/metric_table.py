"""The metric table: the latest result of every file and metric, and its CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.operators.keyed import METRIC_COLUMNS, ROW_KEY, with_keys
from tallygauge.plans.profile import failures, successes
from tallygauge.sources.tables import (
    ROWS,
    Commit,
    compact_tables,
    latest_rows,
    read_commits,
    read_rows,
    write_rows,
)

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("bucket_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("instance", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)

RESULT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESULT_SCHEMA)


def upsert_results(
    results: DataFrame, path: str, writer: str | None = None, batch: int | None = None
) -> Commit | None:
    """Store one batch of results; they replace earlier rows with the same file and metric.

    A batch that its ``writer`` has stored before is not stored again, and there is no commit.
    """
    return write_rows(results.select(*RESULT_SCHEMA.names), path, writer, batch)


def read_commit(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    """The rows of one batch, without the rest of the table."""
    return read_commits(spark, path, [commit]).select(*RESULT_SCHEMA.names)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return latest_rows(read_rows(spark, path, RESULT_SCHEMA), ROW_KEY)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored metrics that have a value, with their display keys."""
    return with_keys(successes(read_results(spark, path))).select(*METRIC_COLUMNS)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return failures(read_results(spark, path))


def compact_metrics(spark: SparkSession, path: str) -> None:
    """The current rows in place of all batches."""
    compact_tables(spark, path, {ROWS: lambda rows: latest_rows(rows, ROW_KEY)})


def export_csv(metrics: DataFrame, path: str) -> None:
    """Write metrics as CSV, one folder per file, replacing only the folders of these files.

    The rows of one file are as many as it has metrics, so one task can write them.
    """
    rows = metrics.select(
        "bucket_name", "file_name", "entity", "instance", "name", F.col("value").cast("string")
    )
    (
        rows.repartition("bucket_name", "file_name")
        .write.partitionBy("bucket_name", "file_name")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .mode("overwrite")
        .csv(path)
    )
