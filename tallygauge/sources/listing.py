"""List the files of a location without opening them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygauge.sources.workspace import new_folder

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/+"


def bucket_of(location: str) -> str:
    """The name a location goes by: the bucket of an object store or the folder itself."""
    return location.rstrip("/").split("://")[-1].split("/")[-1]


def root_of(location: str) -> str:
    root = re.sub(SCHEME, "/", location).strip("/")
    return f"/{root}/" if root else "/"


def relative_name(file_path: str, location: str) -> str:
    """``file_name`` for one path on the driver."""
    return unquote(re.sub(SCHEME, "/", file_path)).split(root_of(location), 1)[-1]


def file_name(path: Column, location: str, encoded: bool = True) -> Column:
    """The name of a file relative to ``location``; works for any file system scheme.

    The paths in ``_metadata.file_path`` are ``encoded`` like URLs.
    """
    root = root_of(location)
    plain = F.regexp_replace(path, SCHEME, "/")
    if encoded:
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return F.substring(plain, F.locate(root, plain) + len(root), F.length(plain))


LISTED = "path string, length bigint, modified timestamp, folder boolean"


def list_files(
    spark: SparkSession, location: str, bucket_name: str | None = None, pattern: str | None = None
) -> DataFrame:
    """All files below ``location`` as manifest rows, plus path, length and time.

    Empty files and names that begin with a dot or underscore are files like others. Folders are
    listed by tasks, level by level, through Arrow's file systems; what is found stays in
    tables in the shared folder. ``pattern`` is a glob on file names.
    """
    folders = spark.createDataFrame([(location.rstrip("/"),)], "path string")
    levels = []
    while True:
        found = folders.repartition("path").mapInArrow(children, LISTED)
        place = new_folder(spark, "listing")
        found.write.parquet(place)
        level = spark.read.schema(found.schema).parquet(place)
        levels.append(level.where("not folder"))
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            break
    files = reduce(DataFrame.union, levels)
    if pattern:
        chosen = F.regexp_extract("path", "([^/]*)$", 1).rlike(glob_pattern(pattern))
        files = files.where(chosen)
    return files.select(
        F.lit(bucket_name or bucket_of(location)).alias("bucket_name"),
        file_name(F.col("path"), location, encoded=False).alias("file_name"),
        F.lit("N").alias("processed"),
        "path",
        "length",
        "modified",
    )


def glob_pattern(pattern: str) -> str:
    """A glob as a regular expression over whole names."""
    parts = {"*": ".*", "?": ".", "{": "(?:", "}": ")", ",": "|"}
    return f"^{''.join(parts.get(c, c if c in '[]-' else re.escape(c)) for c in pattern)}$"


def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is in each folder; paths keep the scheme of their folder's."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, at = fs.FileSystem.from_uri(folder if "://" in folder or not folder.startswith("file:") else folder[5:])
            scheme = folder[: len(folder) - len(at)] if folder.endswith(at) else ""
            found = system.get_file_info(fs.FileSelector(at))
            folders = [i.type == fs.FileType.Directory for i in found]
            columns = [
                pa.array([f"{scheme}{i.path}" for i in found], pa.string()),
                pa.array([i.size for i in found], pa.int64()),
                pa.array([i.mtime_ns and i.mtime_ns // 1000 for i in found], pa.timestamp("us", "UTC")),
                pa.array(folders, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["path", "length", "modified", "folder"])
