"""States kept per file, so that a file can be replaced or taken away, and windows of days over them.

Every batch of states says which files it has and which are gone. The newest batch of a file counts: what older batches have of it is
left out before anything is merged, so a rewritten file is not added twice and a deleted one leaves the total, without
reading the others again. The list of left-out batches has one row per replaced file and batch, not per state.

For windows of days the states of each day are merged into a tree: a node of level ``k`` has the days of one
range of ``2 ** k`` days. A window is a few nodes, at most two of each level, however many days it has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions import columns as C
from tallygauge.functions.local import local_table
from tallygauge.operators.frequency import merge_frequency_states
from tallygauge.operators.joint import merge_joint_states
from tallygauge.operators.scan import merge_scan_states
from tallygauge.operators.states import States
from tallygauge.sources.tables import VERSION, commit_tables, committed, read_commits

FILES = "files"
FILE, GONE = "file_name", "gone"
FILES_SCHEMA = T.StructType([T.StructField(FILE, T.StringType()), T.StructField(GONE, T.BooleanType())])
REFUSED_SCHEMA = "instance string, name string, reason string"
MERGE = {"scan": merge_scan_states, "frequency": merge_frequency_states, "joint": merge_joint_states}
LEVEL, NODE = "level", "node"


def write_file_states(
    states: States | None,
    files: DataFrame,
    path: str,
    gone: DataFrame | None = None,
    writer: str | None = None,
    batch: int | None = None,
) -> None:
    """Store states that are grouped by ``file_name`` among others, in one commit.

    ``files`` lists the files that were measured, with or without rows; ``gone`` those that are there no more.
    """
    listed = files.select(FILE, F.lit(False).alias(GONE))
    if gone is not None:
        listed = listed.unionByName(gone.select(FILE, F.lit(True).alias(GONE)))
    tables = {FILES: listed.distinct()}
    if states is not None:
        tables |= {n: getattr(states, n) for n in MERGE if getattr(states, n) is not None}
        rows = [(*key, reason) for key, reason in states.refused.items()]
        tables["refused"] = local_table(files.sparkSession, REFUSED_SCHEMA, rows)
    commit_tables(path, tables, writer, batch)


def read_file_states(spark: SparkSession, path: str, tables: Iterable[str] = tuple(MERGE)) -> States:
    """The states of the files as they are now, each in the batch that has it last.

    A metric that was refused in any batch stays refused.
    """
    commits = committed(spark, path)
    log = read_commits(spark, path, commits, FILES, FILES_SCHEMA)
    newest = log.groupBy(FILE).agg(F.max(VERSION).alias("newest"), F.max_by(GONE, VERSION).alias("now_gone"))
    left_out = log.join(newest, FILE).where((F.col(VERSION) < F.col("newest")) | F.col("now_gone")).select(FILE, VERSION)
    have = {t for c in commits for t in c.tables}
    kept = {}
    for name in tables:
        if name in have:
            rows = read_commits(spark, path, commits, name)
            kept[name] = rows.join(left_out, [FILE, VERSION], "left_anti").drop(VERSION)
    # At most one row per metric of the specification.
    reasons = {}
    if "refused" in have:
        rows = read_commits(spark, path, commits, "refused").groupBy("instance", "name").agg(F.min("reason").alias("reason"))
        reasons = {(r.instance, r.name): r.reason for r in rows.collect()}
    return States(kept.get("scan"), kept.get("frequency"), kept.get("joint"), reasons)


def day_number(column: str) -> Column:
    return F.unix_date(F.col(C.quoted(column)).cast("date"))


def tree_of_days(states: States, day: str, by: Iterable[str] = (), levels: int = 6) -> dict[int, States]:
    """The states by level: at level ``k`` merged over ranges of ``2 ** k`` days, in column ``node``, and ``by``.

    Each level is merged from the one below it. ``day`` is a date among the grouping columns of the states.
    """
    by = list(by)
    tables = {n: t for n in MERGE if (t := getattr(states, n)) is not None}
    numbered = {n: t.withColumn(NODE, day_number(day)) for n, t in tables.items()}
    found = {}
    for level in range(levels + 1):
        if level:
            numbered = {n: t.withColumn(NODE, F.floor(F.col(NODE) / 2).cast("int")) for n, t in numbered.items()}
        numbered = {n: MERGE[n](t, [*by, NODE]) for n, t in numbered.items()}
        found[level] = States(numbered.get("scan"), numbered.get("frequency"), numbered.get("joint"), states.refused)
    return found


def nodes_of_window(first: int, last: int, levels: int) -> list[tuple[int, int]]:
    """Level and node of the ranges that make up the days from ``first`` to ``last``."""
    nodes, level = [], 0
    while first <= last:
        if level == levels:
            return nodes + [(level, n) for n in range(first, last + 1)]
        if first % 2:
            nodes.append((level, first))
            first += 1
        if first <= last and last % 2 == 0:
            nodes.append((level, last))
            last -= 1
        first, last, level = first // 2, last // 2, level + 1
    return nodes


def write_tree(tree: dict[int, States], path: str) -> None:
    """Store a tree of states below ``path``: a table per kind with all levels, in one commit."""
    tables = {}
    for name in MERGE:
        levels = [getattr(s, name).withColumn(LEVEL, F.lit(k)) for k, s in tree.items() if getattr(s, name) is not None]
        if levels:
            rows = levels[0]
            for more in levels[1:]:
                rows = rows.unionByName(more)
            tables[name] = rows
    commit_tables(path, tables)


def read_window(
    spark: SparkSession, path: str, first: int, last: int, levels: int = 6, refused: dict | None = None
) -> States:
    """The nodes that make up a window of day numbers, from the newest tree of ``path``, ready to merge."""
    commits = committed(spark, path)[-1:]
    wanted: dict[int, list[int]] = {}
    for level, node in nodes_of_window(first, last, levels):
        wanted.setdefault(level, []).append(node)
    picked = F.lit(False)
    for level, nodes in wanted.items():
        picked = picked | ((F.col(LEVEL) == level) & F.col(NODE).isin(nodes))
    have = {t for c in commits for t in c.tables}
    tables = {n: read_commits(spark, path, commits, n).where(picked).drop(VERSION, LEVEL, NODE) for n in MERGE if n in have}
    return States(tables.get("scan"), tables.get("frequency"), tables.get("joint"), refused or {})
