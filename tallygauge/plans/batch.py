"""The whole job: register files, measure the pending ones, store, export, mark."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate, batched, zip_longest

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions.local import local_table
from tallygauge.operators.inputs import Inputs, prepare
from tallygauge.plans.profile import passes, profile_inputs, successes
from tallygauge.plans.unlike import Layout, compatible, csv_columns, read_together, with_absent
from tallygauge.sources import files as files_source
from tallygauge.sources.listing import bucket_of, file_name, list_files, relative_name
from tallygauge.sources.manifest import (
    KEYS,
    compact_manifest,
    pending_files,
    read_log,
    register,
    store_processed,
)
from tallygauge.sources.metric_table import (
    RESULT_DDL,
    compact_metrics,
    export_csv,
    read_commit,
    read_results,
    upsert_results,
)
from tallygauge.sources.tables import compact_when_many, read_commits, write_rows
from tallygauge.sources.workspace import new_folder
from tallygauge.spec import Metric, distinct_metrics, from_parameters

# Files read together, and their bytes. Their names are planned on the driver, as Spark does with any
# list of paths, so the list is bounded and a larger backlog takes several rounds.
FILES_PER_ROUND = 10_000
BYTES_PER_ROUND = 1 << 42
# Groups of files measured in one query; more of them take several, to keep plans small.
GROUPS_PER_QUERY = 16
# Shuffles get one partition for this much input. Adaptive execution merges those that turn out
# small, but it does not split large ones, so too many is the safe side.
BYTES_PER_PARTITION = 128 << 20
PARTITIONS = "spark.sql.shuffle.partitions"
# Commits of a stored table before a run replaces them by one.
MOST_COMMITS = 64


@dataclass
class Job:
    """Where the input is, what to measure on it and where the results go.

    ``listing`` may give the files in place of listing the location, for example from an inventory:
    ``bucket_name``, ``file_name``, ``length`` and ``modified``.

    With ``bad_rows_path``, CSV and JSON rows that do not parse are kept there with their file, are no rows of the data, and
    their number is a metric of the file, ``BadRows``. Without it they count as rows, read as far as they go.
    """

    location: str
    metrics: list[Metric]
    manifest_path: str
    metrics_path: str
    export_path: str | None = None
    file_format: str = "csv"
    bucket_name: str | None = None
    pattern: str | None = None
    schema: object = None
    options: Mapping[str, object] | None = None
    coerce_numeric: bool = False
    files_per_round: int = FILES_PER_ROUND
    bytes_per_round: int = BYTES_PER_ROUND
    listing: DataFrame | None = None
    bad_rows_path: str | None = None

    @property
    def checks_rows(self) -> bool:
        return self.bad_rows_path is not None and self.file_format in files_source.TEXT_FORMATS

    @classmethod
    def from_parameters(cls, parameters: Mapping[str, object], **settings) -> Job:
        """A job from string parameters; ``settings`` are the fields other than the metrics."""
        return cls(metrics=from_parameters(parameters), **settings)

    @property
    def bucket(self) -> str:
        return self.bucket_name or bucket_of(self.location)


def run(spark: SparkSession, job: Job) -> int:
    """Process every pending file of the location; returns how many were measured.

    Files that were registered earlier but are gone now stay pending and are passed over; so does a
    file that cannot be read, with the reason among the failures, while the others go on.
    Files are marked as processed after their metrics and export are stored. A run that stops
    earlier leaves them pending, and repeating them replaces their rows.
    """
    listed = job.listing or list_files(spark, job.location, job.bucket, job.pattern)
    register(spark, job.manifest_path, listed)
    waiting = pending_files(read_log(spark, job.manifest_path)).drop("processed", "length", "modified")
    waiting = waiting.join(listed.select(*KEYS, "length", "modified"), KEYS)
    place = new_folder(spark, "waiting")
    waiting.write.parquet(place)
    done = process_rounds(spark, job, spark.read.schema(waiting.schema).parquet(place))
    compact_when_many(spark, job.manifest_path, MOST_COMMITS, compact_manifest)
    compact_when_many(spark, job.metrics_path, MOST_COMMITS, compact_metrics)
    return done


def process_rounds(spark: SparkSession, job: Job, waiting: DataFrame) -> int:
    """Take the waiting files by name, a bounded number and size at a time, until none is left."""
    done, last = 0, None
    while True:
        rest = waiting if last is None else waiting.where(F.col("file_name") > last)
        found = rest.orderBy("file_name").limit(job.files_per_round).collect()
        if not found:
            return done
        upto = accumulate(row.length or 0 for row in found)
        files = [row for row, total in zip(found, upto) if total <= job.bytes_per_round] or found[:1]
        last = files[-1].file_name
        size = sum(row.length or 0 for row in files)
        partitions = shuffle_partitions(size, int(spark.conf.get(PARTITIONS)))
        with files_source.scoped_settings(spark, {PARTITIONS: str(partitions)}):
            failed = process_files(spark, job, {row.file_name: row.length for row in files})
        measured = [row for row in files if row.file_name not in failed]
        if measured:
            rows = [(job.bucket, row.file_name) for row in measured]
            batch = local_table(spark, "bucket_name string, file_name string", rows)
            store_processed(job.manifest_path, batch.join(waiting, KEYS))
        done += len(measured)


def process_files(spark: SparkSession, job: Job, sizes: dict[str, int]) -> dict[str, str]:
    """Measure some files; the names and reasons of those that cannot be read."""
    empty = [name for name, size in sizes.items() if size == 0]
    hidden = [n for n in sizes if n not in empty and n.rsplit("/", 1)[-1][0] in "._"]
    failed = dict.fromkeys(hidden, "cannot be read: Spark passes over names that begin with a dot or underscore")
    readable = [name for name in sizes if name not in empty and name not in failed]
    if empty:
        store(spark, job, empty_results(spark, job, empty))
    failed |= process_readable(spark, job, readable)
    if failed:
        rows = [(job.bucket, n, "Dataset", "*", "Size", None, reason) for n, reason in failed.items()]
        # What a file was found to hold earlier is not replaced by a failure to read it again.
        known = successes(read_results(spark, job.metrics_path)).where("instance = '*' AND name = 'Size'")
        upsert_results(local_table(spark, RESULT_DDL, rows).join(known, KEYS, "left_anti"), job.metrics_path)
    return failed


def process_readable(spark: SparkSession, job: Job, names: list[str]) -> dict[str, str]:
    """Measure files together; the names and reasons of those that cannot be read.

    Only reading is isolated. If the files can all be read, what failed is computing, storing or
    exporting (or a cluster that lost its executors): the error is raised and the files stay pending.
    """
    try:
        process_groups(spark, job, names)
        return {}
    except (PySparkException, Py4JJavaError):
        failed = unreadable(spark, job, names)
        if not failed:
            raise
        process_groups(spark, job, [n for n in names if n not in failed])
        return failed


def process_groups(spark: SparkSession, job: Job, names: list[str]) -> None:
    if names:
        for some in batched(groups_of(spark, job, names), GROUPS_PER_QUERY):
            process(spark, job, some)


def unreadable(spark: SparkSession, job: Job, names: list[str]) -> dict[str, str]:
    """The files that cannot be read, with reasons: they are read and nothing is stored.

    Halves of what fails are read by themselves, so few bad files take few reads.
    """
    try:
        for group in groups_of(spark, job, names):
            _, _, inputs = group_inputs(spark, job, group)
            inputs.base.write.format("noop").mode("overwrite").save()
        return {}
    except (PySparkException, Py4JJavaError) as error:
        if len(names) == 1:
            return {names[0]: f"cannot be read: {problem(error)}"}
        half = len(names) // 2
        return unreadable(spark, job, names[:half]) | unreadable(spark, job, names[half:])


def problem(error: Exception) -> str:
    """A short reason, alike in every run."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return condition or type(error).__name__


def empty_results(spark: SparkSession, job: Job, names: list[str]) -> DataFrame:
    """What is known of files of no bytes: they have no rows."""
    zero = ("Size", "CountDistinct", "ApproxCountDistinct")
    metrics = distinct_metrics(job.metrics)
    rows = [
        (m.entity, m.instance, m.name, 0.0 if m.kind in zero else None, None if m.kind in zero else "empty")
        for m in metrics
    ]
    kinds = local_table(spark, "entity string, instance string, name string, value double, reason string", rows)
    # One row per file of a round and metric asked for: both are bounded lists.
    files = local_table(spark, "file_name string", [(n,) for n in names])
    return files.withColumn("m", F.lit(1)).join(kinds.withColumn("m", F.lit(1)), "m").drop("m")


def shuffle_partitions(input_bytes: int, configured: int) -> int:
    """Enough partitions for the input, and never fewer than configured."""
    return max(configured, input_bytes // BYTES_PER_PARTITION)


def process(spark: SparkSession, job: Job, some: Iterable[Group]) -> None:
    """Measure, store and export the files of some groups."""
    some = list(some)
    checked = [read_checked_group(spark, job, group) for group in some] if job.checks_rows else []
    read = [group_inputs(spark, job, group, rows) for group, rows in zip_longest(some, checked)]
    # Text is parsed again by every pass, so the few columns in use are kept after the first.
    is_text = job.file_format in files_source.TEXT_FORMATS and not checked
    kept = [i.base for _, _, i in read if is_text and passes(i) > 1]
    for base in kept:
        base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        name = {"file_name": file_name(F.col(files_source.SOURCE_PATH), job.location)}
        parts = []
        if checked:
            parts.append(kept_aside(spark, job, checked, [n for group in some for n in group.names]))
        for group, data, inputs in read:
            listed = local_table(spark, "file_name string", [(n,) for n in group.names])
            results = profile_inputs(inputs, listed, name).results
            parts.append(with_absent(results, data, inputs, group.layouts) if group.layouts else results)
        store(spark, job, reduce(DataFrame.unionByName, parts))
    finally:
        for base in kept:
            base.unpersist()


def read_checked_group(spark: SparkSession, job: Job, group: Group) -> DataFrame:
    """The rows of a group's files, parsed once and stored with the text of those that do not parse."""
    paths, schema = paths_of(job, group.names), group.schema
    if schema is None:
        found = files_source.read_files(spark, paths, job.file_format, None, job.options)
        schema = found.drop(files_source.SOURCE_PATH).schema
    rows = files_source.read_checked(spark, paths, job.file_format, schema, job.options)
    # Which rows parse is told by all columns of the text; a reader that is asked for a few would tell otherwise.
    place = new_folder(spark, "checked")
    rows.write.parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def kept_aside(spark: SparkSession, job: Job, checked: list[DataFrame], names: list[str]) -> DataFrame:
    """Store the rows of some files that do not parse; how many each file has, as results."""
    bad = reduce(DataFrame.unionByName, map(files_source.bad_rows, checked))
    rows = bad.select(
        F.lit(job.bucket).alias("bucket_name"),
        file_name(F.col(files_source.SOURCE_PATH), job.location).alias("file_name"),
        F.col(files_source.BAD_ROW).alias("row"),
    )
    commit = write_rows(rows, job.bad_rows_path)
    counts = read_commits(spark, job.bad_rows_path, [commit]).groupBy("file_name").agg(F.count("*").alias("n"))
    listed = local_table(spark, "file_name string", [(n,) for n in names])
    return listed.join(counts, "file_name", "left").select(
        "file_name",
        F.lit("Dataset").alias("entity"),
        F.lit("*").alias("instance"),
        F.lit("BadRows").alias("name"),
        F.coalesce("n", F.lit(0)).cast("double").alias("value"),
        F.lit(None).cast("string").alias("reason"),
    )


def store(spark: SparkSession, job: Job, results: DataFrame) -> None:
    """Keep and export the results of some files."""
    commit = upsert_results(results.withColumn("bucket_name", F.lit(job.bucket)), job.metrics_path)
    if job.export_path:
        export_csv(successes(read_commit(spark, job.metrics_path, commit)), job.export_path)


@dataclass
class Group:
    """Files that are read as one table: of one schema, or of several compatible layouts."""

    names: list[str]
    schema: object = None
    layouts: list[Layout] = field(default_factory=list)


def groups_of(spark: SparkSession, job: Job, names: list[str]) -> list[Group]:
    """The files in groups that can be read as one table.

    JSON and CSV files go together unless a column has two types or spellings. CSV files whose header
    needs the reader's own rules go with those of the same header, files whose first line is blank alone.
    """
    if job.schema is not None:
        return [Group(names, job.schema)]
    if job.file_format not in files_source.TEXT_FORMATS:
        return parquet_groups(spark, job, names)
    options = dict(job.options or {})
    is_csv = job.file_format == "csv"
    if is_csv and str(options.get("header", True)).lower() == "false":
        return [Group(names)]
    discover = files_source.first_lines if is_csv else files_source.json_schemas
    found = discover(spark, paths_of(job, names))
    by_key: dict[str, dict[str, str]] = defaultdict(dict)
    for path, key in found.items():
        if key and key.strip():
            by_key[key][relative_name(path, job.location)] = path
    layouts, groups = [], []
    for key, paths in by_key.items():
        columns = csv_columns(key, options) if is_csv else json_columns(key)
        if columns is None:
            groups.append(Group(list(paths), None if is_csv or not key.startswith("STRUCT<") else key))
        else:
            layouts.append(Layout(paths, columns))
    if job.checks_rows:
        # Whether a row has the cells of its header is told file by file, so layouts are not mixed.
        groups += [Group(list(layout.paths), layout.columns) for layout in layouts]
        layouts = []
    for members in compatible(layouts):
        own = [n for layout in members for n in layout.paths]
        groups.append(Group(own, layouts=members))
    known = {n for paths in by_key.values() for n in paths}
    return [*groups, *(Group([n]) for n in names if n not in known)]


def json_columns(schema: str) -> T.StructType | None:
    """The fields of a JSON layout, if they are told apart without regard to case."""
    if not schema.startswith("STRUCT<"):
        return None
    columns = T.DataType.fromDDL(schema)
    return columns if len({n.lower() for n in columns.names}) == len(columns.names) else None


def parquet_groups(spark: SparkSession, job: Job, names: list[str]) -> list[Group]:
    """The files by the schema of their footers, which tasks read."""
    found = files_source.parquet_schemas(spark, paths_of(job, names))
    known = {relative_name(path, job.location): key for path, key in found.items()}
    groups: dict[str, list[str]] = defaultdict(list)
    for name in names:
        groups[known.get(name) or f"\0{name}"].append(name)
    return [Group(same) for same in groups.values()]


def paths_of(job: Job, names: Iterable[str]) -> list[str]:
    return [f"{job.location.rstrip('/')}/{name}" for name in names]


def group_inputs(
    spark: SparkSession, job: Job, group: Group, checked: DataFrame | None = None
) -> tuple[Group, DataFrame, Inputs]:
    """The rows of a group's files, and what its metrics need of them."""
    paths = paths_of(job, group.names)
    if checked is not None:
        data = files_source.good_rows(checked)
    elif group.layouts:
        data = read_together(spark, group.layouts, paths, job.file_format, job.options or {})
    else:
        data = files_source.read_files(spark, paths, job.file_format, group.schema, job.options)
    return group, data, prepare(data, job.metrics, [files_source.SOURCE_PATH], job.coerce_numeric)
