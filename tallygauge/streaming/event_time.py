"""Metrics of windows of event time, kept in the state of one stream until the watermark closes them.

Every family of states is a streaming aggregation per window in Spark's RocksDB state store. A window is written
once, when the watermark has passed its end, and a row that comes after that is late: the aggregations leave it out.
What arrives is counted beside them before any row is left out, so late rows are known by window.

All of it is one query with one watermark. The states, the counts of a batch and the batch itself are
committed together, so a run that dies goes on where it stopped and adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallygauge.functions import columns as C
from tallygauge.operators.frequency import frequency_states
from tallygauge.operators.inputs import Inputs, prepare
from tallygauge.operators.joint import joint_states
from tallygauge.operators.scan import ROWS, scan_states
from tallygauge.operators.states import States
from tallygauge.spec import Metric

WINDOW = "window_start"
KIND, ARRIVED, LATEST = "state", "arrived", "latest"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Different windows and groups a task keeps before it hands their counts on.
COUNTS_KEPT = 100_000


def ingest_windows(
    stream: DataFrame,
    metrics: Iterable[Metric],
    time: str,
    length: str,
    delay: str,
    path: str,
    checkpoint: str,
    by: Iterable[str] = (),
    coerce_numeric: bool = False,
) -> StreamingQuery:
    """Add new rows to the windows of ``length`` they belong to and store below ``path`` those that are over.

    The watermark is the latest ``time`` of the batches before, less ``delay``. Rows without a time belong to no window;
    they are counted under a null window. The query ends when nothing new is left; windows that are not
    over stay in the state below ``checkpoint`` and go on in the next run with the same specification.
    """
    metrics, by = list(metrics), list(by)
    if WINDOW in by:
        raise ValueError(f"a grouping column cannot be named {WINDOW}")
    timed = stream.withColumn("__time", event_time(stream, time))
    start = F.window("__time", length).getField("start").alias(WINDOW)
    marked = timed.withWatermark("__time", delay)
    window = F.window("__time", length).alias(WINDOW)
    inputs = prepare(marked, metrics, [window, *by], coerce_numeric)
    if inputs.refused:
        # The schema of a stream is given, so this is known before any row is.
        raise ValueError("; ".join(f"{m.name} of {m.instance}: {why}" for m, why in inputs.refused.items()))
    tables = {"scan": scan_states(inputs, mergeable=True), **count_tables(inputs)}
    parts = [as_part(name, table.withColumn(WINDOW, F.col(WINDOW)["start"])) for name, table in tables.items()]
    # F.window leaves rows without a time out, so these come from the same stream beside it.
    untimed = timed.where("__time IS NULL").withColumn(WINDOW, F.lit(None).cast("timestamp"))
    keys = [WINDOW, *map(C.quoted, by)]
    arrivals = timed.where("__time IS NOT NULL").select(start, *keys[1:], "__time")
    arrivals = arrivals.unionByName(untimed.select(*keys, "__time"))
    parts.append(as_part(ARRIVED, counted_by_task(arrivals, [WINDOW, *by])))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    with rocksdb(stream.sparkSession):
        return (
            rows.writeStream.format("parquet")
            .outputMode("append")
            .partitionBy(KIND)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def event_time(stream: DataFrame, time: str) -> Column:
    """The time as a point in time, which watermarks need; a time without a zone is taken as UTC in every session."""
    kind = stream.select(C.quoted(time)).schema[0].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(C.quoted(time))
    if not isinstance(kind, T.TimestampNTZType):
        raise ValueError(f"column {time} is {kind.simpleString()}, not a timestamp")
    t = C.quoted(time)
    minutes = f"unix_date(CAST({t} AS DATE)) * 1440L + hour({t}) * 60L + minute({t})"
    return F.expr(f"timestamp_micros(({minutes}) * 60000000L + CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT))")


def count_tables(inputs: Inputs) -> dict[str, DataFrame]:
    tables = {"frequency": frequency_states(inputs), "joint": joint_states(inputs)}
    return {kind: table for kind, table in tables.items() if table is not None}


def as_part(kind: str, table: DataFrame) -> DataFrame:
    """The rows of a table as one struct, so that tables with other columns fit into one output."""
    return table.select(F.lit(kind).alias(KIND), F.struct("*").alias(kind))


def counted_by_task(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and latest time per key, as far as a task of a batch sees them.

    Nothing is kept from batch to batch: the partial counts are rows of the output and added up when they are read.
    """
    fields = [rows.schema[k] for k in keys]
    kept = [T.StructField(ROWS, T.LongType()), T.StructField(LATEST, T.TimestampType())]
    schema = T.StructType([*(T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)), *kept])
    names = [f"k{i}" for i in range(len(keys))]
    plain = rows.select(*[F.col(C.quoted(k)).alias(n) for k, n in zip(keys, names)], F.col("__time").alias(LATEST))

    def added(table: pa.Table, sums: list[tuple]) -> pa.Table:
        found = table.group_by(names).aggregate(sums)
        return found.rename_columns([*names, ROWS, LATEST])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            own = added(pa.Table.from_batches([batch]), [([], "count_all"), (LATEST, "max")])
            held = own if held is None else added(pa.concat_tables([held, own]), [(ROWS, "sum"), (LATEST, "max")])
            if held.num_rows > COUNTS_KEPT:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    counted = plain.mapInArrow(count, schema)
    return counted.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], ROWS, LATEST)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB, on disk; the session's own choice is back after."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def read_kind(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    rows = spark.read.parquet(path)
    if kind not in rows.columns:
        return None
    return rows.where(F.col(KIND) == kind).select(f"{C.quoted(kind)}.*")


def read_windows(spark: SparkSession, path: str) -> States:
    """The states of all windows that are over, ready to merge over any of their columns."""
    return States(*(read_kind(spark, path, kind) for kind in ("scan", "frequency", "joint")), {})


def late_rows(spark: SparkSession, path: str, length: str, delay: str, by: Iterable[str] = ()) -> DataFrame:
    """What arrived, what was counted and what came late, per window and group.

    ``over`` tells whether the watermark has passed the window; as long as it has not, its rows are still in the state of the
    stream and ``counted`` and ``late`` are null. Rows without a time have a null window and are neither.
    """
    keys = [WINDOW, *by]
    names = [f"__k{i}" for i in range(len(keys))]
    arrived = read_kind(spark, path, ARRIVED).groupBy(*map(C.quoted, keys))
    arrived = arrived.agg(F.sum(ROWS).alias("arrived"), F.max(LATEST).alias(LATEST))
    counted = read_kind(spark, path, "scan")
    if counted is None:
        counted = arrived.where("false").select(*map(C.quoted, keys), F.lit(0).cast("bigint").alias(ROWS))
    counted = counted.select(*[F.col(C.quoted(k)).alias(n) for k, n in zip(keys, names)], F.col(ROWS).alias("__counted"))
    watermark = arrived.agg(F.max(LATEST) - F.expr(f"INTERVAL {delay}")).scalar()
    end = F.col(WINDOW) + F.expr(f"INTERVAL {length}")
    known = arrived.withColumn("over", F.coalesce(end <= watermark, F.lit(False)))
    same = reduce(lambda a, b: a & b, [F.col(C.quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    found = F.when(F.col("over"), F.coalesce("__counted", F.lit(0)))
    rows = known.join(counted, same, "left").withColumn("counted", found)
    return rows.select(*map(C.quoted, keys), "over", "arrived", "counted", (F.col("arrived") - F.col("counted")).alias("late"))
