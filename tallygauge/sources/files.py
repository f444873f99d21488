"""Read many data files of one format together."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions.local import local_table

FORMATS = ("csv", "json", "parquet")
TEXT_FORMATS = ("csv", "json")
SOURCE_PATH = "__source_path"
BAD_ROW = "__bad_row"
LONGEST_HEADER = 1 << 20
MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"


def read_files(
    spark: SparkSession,
    paths: str | Iterable[str],
    file_format: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """One frame over all files, with the file of each row in ``__source_path`` (written like a URL).

    CSV has a header and its columns are text unless a schema is given; with a schema, a file
    whose header differs is an error rather than read by position. JSON types are inferred.
    """
    if file_format not in FORMATS:
        raise ValueError(f"file format is one of {FORMATS}, got {file_format!r}")
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if file_format == "parquet" and schema is None:
        reader = reader.option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(T.DataType.fromDDL(schema) if isinstance(schema, str) else schema)
    paths = [paths] if isinstance(paths, str) else [literal_path(p) for p in paths]
    data = reader.options(**dict(options or {})).load(paths)
    return data.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def read_checked(
    spark: SparkSession,
    paths: str | Iterable[str],
    file_format: str,
    schema: T.StructType | str,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Like ``read_files`` for CSV or JSON of a given schema, with the text of rows that do not parse in ``__bad_row``.

    Such a row is broken JSON, has more or fewer cells than the header, or a cell that is not of its type. Its other
    columns are as far as they could be read; ``__bad_row`` is null for all other rows. Write the rows before
    asking for some of their columns: a reader that is asked for a few does not look at the others.
    """
    if file_format not in TEXT_FORMATS:
        raise ValueError(f"rows are checked in {TEXT_FORMATS}, got {file_format!r}")
    schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField(BAD_ROW, T.StringType())])
    reader = spark.read.format(file_format).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    paths = [paths] if isinstance(paths, str) else [literal_path(p) for p in paths]
    data = reader.schema(wide).options(**dict(options or {})).load(paths)
    return data.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW)


def bad_rows(checked: DataFrame) -> DataFrame:
    """``__source_path`` and ``__bad_row`` of the rows that do not parse."""
    return checked.where(F.col(BAD_ROW).isNotNull()).select(SOURCE_PATH, BAD_ROW)


def literal_path(path: str) -> str:
    """A path in which no character is taken as a glob."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def first_lines(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """The first line of every file that has one.

    For this job a file is one task, whatever its size, and the task stops after its first batch
    of lines, so almost nothing is read. One line per file comes to the driver, which planned
    the same list of files; a line of more than ``LONGEST_HEADER`` bytes is no header to tell and comes blank.
    """

    def first_row(batches):
        for batch in batches:
            if batch.num_rows:
                path, line = (batch.column(i)[:1] for i in range(2))
                if len((line[0].as_py() or "").encode()) > LONGEST_HEADER:
                    line = pa.array([""])
                yield pa.RecordBatch.from_arrays([path, line], batch.schema.names)
                return

    one_task_per_file = {
        MAX_PARTITION_BYTES: str(1 << 50),
        "spark.sql.files.openCostInBytes": str(1 << 50),
    }
    with scoped_settings(spark, one_task_per_file):
        text = spark.read.text([literal_path(p) for p in paths])
        lines = text.select(F.col("_metadata.file_path").alias(SOURCE_PATH), "value")
        first = lines.mapInArrow(first_row, lines.schema)
        return {row[SOURCE_PATH]: row.value for row in first.collect()}


def parquet_schemas(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """A digest of the schema of every Parquet file, from its footer, which a task reads."""

    def footers(batches):
        for batch in batches:
            digests = []
            for path in batch.column(0).to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as file:
                    schema = parquet.read_schema(file).remove_metadata()
                fields = "\n".join(f"{f.name} {f.type}" for f in schema)
                digests.append(hashlib.sha256(fields.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests)], ["path", "digest"])

    rows = local_table(spark, "path string", [(p,) for p in paths])
    tasks = spark.sparkContext.defaultParallelism
    return {r.path: r.digest for r in rows.repartition(tasks).mapInArrow(footers, "path string, digest string").collect()}


@contextmanager
def scoped_settings(spark: SparkSession, settings: Mapping[str, str]):
    """Session settings for jobs that run inside the block."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def json_schemas(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """The schema of every JSON file over all its lines, in one pass for all files together.

    The answer is one short text per file. Fields of mixed type are read as text.
    """
    text = spark.read.text([literal_path(p) for p in paths])
    parsed = text.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.try_parse_json("value").alias("document"),
    )
    found = parsed.groupBy(SOURCE_PATH).agg(F.schema_of_variant_agg("document").alias("found"))
    return {row[SOURCE_PATH]: struct_of(row.found) for row in found.collect()}


def struct_of(variant_schema: str) -> str:
    """The schema of a parsed document as the type a reader takes."""
    schema = variant_schema.replace("OBJECT<", "STRUCT<")
    schema = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", schema)
    return re.sub(r"\b(VOID|VARIANT)\b(?!`?:)", "STRING", schema)
