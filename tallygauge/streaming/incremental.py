"""Measure only what is new, with the file stream keeping track of what was seen."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallygauge.functions.local import local_table
from tallygauge.operators.frequency import merge_frequency_states
from tallygauge.operators.inputs import prepare
from tallygauge.operators.joint import merge_joint_states
from tallygauge.operators.scan import merge_scan_states
from tallygauge.operators.states import States, compute_states
from tallygauge.plans.profile import passes, profile_inputs
from tallygauge.sources.files import SOURCE_PATH
from tallygauge.sources.listing import bucket_of, file_name
from tallygauge.sources.metric_table import upsert_results
from tallygauge.sources.tables import (
    VERSION,
    commit_tables,
    committed,
    compact_tables,
    read_commits,
    read_text,
)
from tallygauge.spec import Metric

STATE_TABLES = ("scan", "frequency", "joint")
REFUSED_SCHEMA = "instance string, name string, reason string"


def file_stream(
    spark: SparkSession,
    location: str,
    file_format: str,
    schema,
    options: Mapping[str, object] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a location as a stream with the file of each row in ``__source_path``."""
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    data = reader.options(**dict(options or {})).load(location)
    return data.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def ingest_files(
    stream: DataFrame,
    location: str,
    metrics: Iterable[Metric],
    metrics_path: str,
    checkpoint: str,
    bucket_name: str | None = None,
    coerce_numeric: bool = False,
) -> StreamingQuery:
    """Measure every new file once and store its metrics; ends when nothing new is left.

    A file enters in one micro-batch as a whole. A batch that is replayed after a failure is
    known by the stream's own id and its number, so nothing is stored twice.
    """
    bucket = bucket_name or bucket_of(location)
    metrics = list(metrics)
    name = {"file_name": file_name(F.col(SOURCE_PATH), location)}

    def store(batch: DataFrame, batch_id: int) -> None:
        inputs = prepare(batch, metrics, [SOURCE_PATH], coerce_numeric)
        if passes(inputs) > 1:
            inputs.base.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            results = profile_inputs(inputs, names=name).results.withColumn("bucket_name", F.lit(bucket))
            upsert_results(results, metrics_path, stream_id(batch.sparkSession, checkpoint), batch_id)
        finally:
            inputs.base.unpersist()

    return run_once(stream, store, checkpoint)


def ingest_states(
    stream: DataFrame,
    metrics: Iterable[Metric],
    by: Iterable[str | Column],
    states_path: str,
    checkpoint: str,
    coerce_numeric: bool = False,
) -> StreamingQuery:
    """Add the states of new rows to a state table, for groups that grow over time.

    Metrics of everything seen so far come from ``read_states`` without reading the rows again.
    """
    metrics, by = list(metrics), list(by)

    def store(batch: DataFrame, batch_id: int) -> None:
        # The batch is read once: its text is parsed here and not again by every state table.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            states = compute_states(batch, metrics, by, coerce_numeric)
            write_states(states, states_path, stream_id(batch.sparkSession, checkpoint), batch_id)
        finally:
            batch.unpersist()

    return run_once(stream, store, checkpoint)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps as long as its checkpoint; a fresh checkpoint is another stream."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def run_once(stream: DataFrame, store, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_states(states: States, path: str, writer: str | None = None, batch: int | None = None) -> None:
    """Store one batch of states below ``path``: all tables in one commit, written side by side."""
    tables = {n: getattr(states, n) for n in STATE_TABLES if getattr(states, n) is not None}
    rows = [(*key, reason) for key, reason in states.refused.items()]
    tables["refused"] = local_table(states.scan.sparkSession, REFUSED_SCHEMA, rows)
    commit_tables(path, tables, writer, batch)


def read_states(spark: SparkSession, path: str, states: Iterable[str]) -> States:
    """All stored batches of the named state tables, ready to merge.

    A metric that was refused in any batch is refused, since rows are missing from its state.
    """
    commits = committed(spark, path)
    tables = {n: read_commits(spark, path, commits, n).drop(VERSION) for n in states}
    # At most one row per metric of the specification.
    rows = read_commits(spark, path, commits, "refused").groupBy("instance", "name").agg(F.min("reason").alias("reason"))
    reasons = {(r.instance, r.name): r.reason for r in rows.collect()}
    return States(tables["scan"], tables.get("frequency"), tables.get("joint"), reasons)


def compact_states(spark: SparkSession, path: str, by: Iterable[str]) -> None:
    """The merged states of all batches, at the grain of their grouping columns, in place of the batches."""
    by = list(by)
    merge = {"scan": merge_scan_states, "frequency": merge_frequency_states, "joint": merge_joint_states}
    reduced = {n: lambda rows, f=merge[n]: f(rows.drop(VERSION), by) for n in STATE_TABLES}
    reduced["refused"] = lambda rows: rows.groupBy("instance", "name").agg(F.min("reason").alias("reason"))
    compact_tables(spark, path, reduced)
