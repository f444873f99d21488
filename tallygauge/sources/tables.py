"""Append-only Parquet tables with commits.

A write puts its rows into a folder of its own and then creates one small commit file, whose name is
the next version. Creating it fails if another writer took the version, who then takes the one
after, so versions are unique and grow where the file system creates a file only once (HDFS, local
disks; object stores with conditional writes). Readers read what is committed and nothing else; several
tables that belong together are in one commit. A batch that says who writes it is stored once,
however often it is replayed. A compaction is a commit that stands for the versions it lists, which
end before the first one that is still being written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions.local import local_table

# Names that stored rows may not use.
VERSION, WRITE = "__version", "__write"
COMMITS = "_commits"
ROWS = "rows"


@dataclass(frozen=True)
class Commit:
    """``tables`` has the folder and schema per table; ``replaced`` the versions it stands for.

    ``batches`` is the last batch of every writer that it or what it replaces has stored.
    """

    version: int
    tables: dict[str, list[str]]
    replaced: list[int] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def order(self) -> int:
        """Where its rows stand: a compaction's stand before what was committed meanwhile."""
        return max(self.replaced, default=self.version)


def hadoop(spark: SparkSession, path: str):
    """The path and its file system, of any scheme Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    place, system = hadoop(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist yet; False if it does."""
    place, system = hadoop(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def committed(spark: SparkSession, path: str) -> list[Commit]:
    """The commits that count, in order. A table is compacted long before these are many."""
    return commits_and_gap(spark, path)[0]


def commits_and_gap(spark: SparkSession, path: str) -> tuple[list[Commit], int | None]:
    """The commits that count and the first version whose writer has not ended."""
    place, system = hadoop(spark, f"{path.rstrip('/')}/{COMMITS}")
    if not system.exists(place):
        return [], None
    files = {int(f.getName()): f for f in (s.getPath() for s in system.listStatus(place)) if f.getName().isdigit()}
    found, gone, gap = [], set(), None
    for version in sorted(files, reverse=True):
        if version in gone:
            continue
        text = read_text(spark, files[version].toString())
        if not text.endswith("\n"):
            gap = version
            continue
        commit = Commit(version=version, **json.loads(text))
        found.append(commit)
        gone.update(commit.replaced)
    return sorted(found, key=lambda c: (c.order, c.version)), gap


def stored_batches(commits: Iterable[Commit]) -> dict[str, int]:
    last: dict[str, int] = {}
    for commit in commits:
        for writer, batch in commit.batches.items():
            last[writer] = max(batch, last.get(writer, batch))
    return last


def commit_tables(
    path: str,
    tables: Mapping[str, DataFrame],
    writer: str | None = None,
    batch: int | None = None,
    replaced: list[Commit] | None = None,
) -> Commit | None:
    """Store rows of one or more tables at once; None if ``writer`` has stored the batch before.

    Batches of a writer come in order. The tables are written side by side.
    """
    path = path.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    for df in tables.values():
        if clash := {VERSION, WRITE} & {c.lower() for c in df.columns}:
            raise ValueError(f"stored rows cannot have a column {sorted(clash)}")
    if batch is not None and batch <= stored_batches(committed(spark, path)).get(writer, -1):
        return None
    name = uuid.uuid4().hex

    def write(table: str) -> list[str]:
        tables[table].write.parquet(f"{path}/{table}/{WRITE}={name}")
        return [name, tables[table].schema.json()]

    with ThreadPoolExecutor(len(tables)) as pool:
        written = dict(zip(tables, pool.map(write, tables), strict=True))
    batches = stored_batches(replaced or [])
    if batch is not None:
        batches[writer] = batch
    stands_for = sorted({v for c in replaced or [] for v in (c.version, *c.replaced)})
    while True:
        commit = Commit(next_version(spark, path), written, stands_for, batches)
        content = {k: v for k, v in asdict(commit).items() if k != "version"}
        if create_text(spark, f"{path}/{COMMITS}/{commit.version:012d}", json.dumps(content) + "\n"):
            return commit


def next_version(spark: SparkSession, path: str) -> int:
    place, system = hadoop(spark, f"{path}/{COMMITS}")
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    return max((int(n) for n in names if n.isdigit()), default=0) + 1


def read_commits(
    spark: SparkSession, path: str, commits: list[Commit], table: str = ROWS, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of some commits with their ``__version``; an empty frame of ``schema`` if there are none."""
    have = [c for c in commits if table in c.tables]
    fields: dict[str, T.StructField] = {f.name: f for f in schema.fields} if schema else {}
    for commit in have:
        for own in T.StructType.fromJson(json.loads(commit.tables[table][1])).fields:
            fields.setdefault(own.name, T.StructField(own.name, own.dataType))
    full = T.StructType([*fields.values(), T.StructField(WRITE, T.StringType())])
    if not have:
        if schema is None:
            raise ValueError(f"nothing is stored in {table} of {path}")
        return spark.createDataFrame([], full).withColumn(VERSION, F.lit(0).cast("bigint")).drop(WRITE)
    base = f"{path.rstrip('/')}/{table}"
    folders = [f"{base}/{WRITE}={c.tables[table][0]}" for c in have]
    rows = spark.read.schema(full).option("basePath", base).parquet(*folders)
    orders = local_table(spark, f"{WRITE} string, {VERSION} bigint", [(c.tables[table][0], c.order) for c in have])
    return rows.join(orders, WRITE).drop(WRITE)


def write_rows(rows: DataFrame, path: str, writer: str | None = None, batch: int | None = None) -> Commit | None:
    return commit_tables(path, {ROWS: rows}, writer, batch)


def read_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return read_commits(spark, path, committed(spark, path), schema=schema)


def compact_tables(spark: SparkSession, path: str, reduced: Mapping[str, Callable[[DataFrame], DataFrame]]) -> None:
    """Replace what is committed by one commit with the reduced rows of every table.

    Commits after one that is still being written stay as they are, so that its rows keep their place.
    """
    commits, gap = commits_and_gap(spark, path)
    commits = [c for c in commits if gap is None or c.version < gap]
    have = {t for c in commits for t in c.tables}
    tables = {t: f(read_commits(spark, path, commits, t)).drop(VERSION) for t, f in reduced.items() if t in have}
    if len(commits) > 1:
        commit_tables(path, tables, replaced=commits)


def compact_when_many(spark: SparkSession, path: str, most: int, compact: Callable[[SparkSession, str], None]) -> None:
    """Compact a table that has more than ``most`` commits."""
    if len(committed(spark, path)) > most:
        compact(spark, path)


def latest_rows(rows: DataFrame, keys: Iterable[str], version: str = VERSION) -> DataFrame:
    """The row with the highest version of every key.

    An aggregation rather than a ranking window: versions are reduced before the shuffle and
    no key is gathered in one task.
    """
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys and c != version]
    if not others:
        return rows.select(*keys).distinct()
    newest = F.max_by(F.struct(*others), version).alias("__newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "__newest.*")
