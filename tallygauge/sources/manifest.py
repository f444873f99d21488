"""The manifest: which files are known and which of them have been processed.

The table is a log. A file is registered with its length and time; processing it is recorded with
the length and time it had. A file that changed since is pending again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.sources.tables import (
    ROWS,
    VERSION,
    compact_tables,
    read_rows,
    write_rows,
)

# The manifest columns and the two states of a file.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("bucket_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("processed", T.StringType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [*MANIFEST_SCHEMA.fields, T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType())]
)
PENDING, PROCESSED = "N", "Y"
KEYS = ["bucket_name", "file_name"]
CONTENT = ["length", "modified"]


def with_content(files: DataFrame) -> DataFrame:
    """``files`` with the length and time of each; null where a listing does not tell them."""
    known = {f.name: f.dataType for f in LOG_SCHEMA.fields}
    missing = [c for c in CONTENT if c not in files.columns]
    return files.withColumns({c: F.lit(None).cast(known[c]) for c in missing})


def same_content(a: Column, b: Column) -> Column:
    """Unknown lengths and times differ from none."""
    different = [(a[c] != b[c]) for c in CONTENT]
    return ~F.coalesce(different[0], F.lit(False)) & ~F.coalesce(different[1], F.lit(False))


def new_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files the manifest does not know, or knows with another content, as pending rows."""
    fresh = with_content(listed).select(*KEYS, F.struct(*CONTENT).alias("now")).dropDuplicates(KEYS)
    known = with_content(manifest).select(*KEYS, F.struct(*CONTENT).alias("before"))
    changed = F.col("before").isNull() | ~same_content(F.col("now"), F.col("before"))
    rows = fresh.join(known, KEYS, "left").where(changed)
    content = ["now.length", "now.modified"] if set(CONTENT) <= set(listed.columns) else []
    return rows.select(*KEYS, F.lit(PENDING).alias("processed"), *content)


def current_log(log: DataFrame) -> DataFrame:
    """One row per file from all rows ever written, with the length and time last seen."""
    content = F.struct(*CONTENT)
    is_listing = F.col("processed") == PENDING
    files = log.groupBy(*KEYS).agg(
        F.coalesce(F.max_by(F.when(is_listing, content), F.when(is_listing, F.col(VERSION))), F.max_by(content, VERSION)).alias("seen"),
        F.collect_set(F.when(~is_listing, content)).alias("done"),
    )
    done = F.exists("done", lambda d: same_content(d, F.col("seen")))
    state = F.when(done, PROCESSED).otherwise(PENDING).alias("processed")
    return files.select(*KEYS, state, "seen.length", "seen.modified")


def current_state(log: DataFrame) -> DataFrame:
    """One row per file; once processed, a file stays processed unless it changes."""
    return current_log(log).drop(*CONTENT)


def pending_files(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("processed") == PENDING)


def mark_processed(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """The manifest with the files of ``done`` set to processed."""
    finished = done.select(*KEYS).distinct().withColumn("__done", F.lit(True))
    state = F.when(F.col("__done"), PROCESSED).otherwise(F.col("processed"))
    return manifest.join(finished, KEYS, "left").withColumn("processed", state).drop("__done")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return current_log(read_rows(spark, path, LOG_SCHEMA))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path).drop(*CONTENT)


def write_manifest(rows: DataFrame, path: str) -> None:
    write_rows(with_content(rows).select(*LOG_SCHEMA.names), path)


def register(spark: SparkSession, path: str, listed: DataFrame) -> None:
    """Add the files of a listing that are not in the manifest table yet, or have changed."""
    write_manifest(new_files(listed, read_log(spark, path)), path)


def store_processed(path: str, done: DataFrame) -> None:
    """Record that the files of ``done`` are processed as they were listed."""
    write_manifest(done.withColumn("processed", F.lit(PROCESSED)).dropDuplicates(KEYS), path)


def compact_manifest(spark: SparkSession, path: str) -> None:
    """One row per file in place of the log."""
    compact_tables(spark, path, {ROWS: current_log})
