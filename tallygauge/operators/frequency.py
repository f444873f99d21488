"""Metrics that need to know how often each value occurs.

All columns share one pass: every row is expanded to one ``(group, column, value)`` row per
measured column and counted. Counting starts before the shuffle, so a value that fills a third
of the rows travels as one row per task. Values keep their type: there is one value column
per type family and exactly one of them is used in a row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.functions import columns as C
from tallygauge.functions.local import local_table
from tallygauge.operators.inputs import Inputs, result_rows, result_struct
from tallygauge.operators.scan import without_rows
from tallygauge.spec import FREQUENCY, Metric

# Names that grouping columns will not have.
COLUMN, COPIES = "__column", "__copies"
VALUE = "__value_"


def frequency_states(inputs: Inputs) -> DataFrame | None:
    """The frequency table: grouping columns, the column's name, typed values, their copies.

    Nulls are counted as rows of their own, so the counts of a column add up to all rows.
    """
    names = list(dict.fromkeys(m.columns[0] for m in inputs.of(FREQUENCY)))
    if not names:
        return None
    families = list(dict.fromkeys(C.group_type(inputs.types[n]) for n in names))
    cells = {
        f"v{i}": C.group_value(inputs.cell(name), inputs.types[name])
        for i, name in enumerate(names)
    }
    sets = []
    for i, name in enumerate(names):
        own = families.index(C.group_type(inputs.types[name]))
        sets.append([f"v{i}" if f == own else f"null{f}" for f in range(len(families))])
    values = [VALUE + type_tag(t) for t in families]
    long = expand(inputs, cells, families, sets, values)
    counted = long.groupBy(*map(C.quoted, inputs.by), "__set", *values).agg(
        F.count(F.lit(1)).alias(COPIES)
    )
    column = lookup("__set", {str(i): n for i, n in enumerate(names)})
    return counted.selectExpr(*map(C.quoted, inputs.by), f"{column} AS {COLUMN}", *values, COPIES)


def expand(
    inputs: Inputs,
    cells: dict[str, str],
    families: list[str],
    sets: list[list[str]],
    outputs: list[str],
) -> DataFrame:
    """One row per input row and set, with the set's cells under ``outputs``.

    ``cells`` are SQL values by name, the sets name them or ``null<i>`` for a null of family i.
    This is SQL UNPIVOT with several value columns, which Spark runs as one Expand inside the
    generated code of the scan.
    """
    size = len(families)
    nulls = {}
    for cells_of_set in sets:
        for position, name in enumerate(cells_of_set):
            if not name.startswith("null"):
                nulls[position % size] = f"IF(false, {cells[name]}, NULL) AS null{position % size}"
    narrow = inputs.base.selectExpr(
        *map(C.quoted, inputs.by), *[f"{sql} AS {n}" for n, sql in cells.items()], *nulls.values()
    )
    choices = ", ".join(f"({', '.join(s)}) AS `{i}`" for i, s in enumerate(sets))
    return narrow.sparkSession.sql(
        f"SELECT * FROM {{narrow}} UNPIVOT INCLUDE NULLS "
        f"(({', '.join(outputs)}) FOR __set IN ({choices}))",
        narrow=narrow,
    )


def type_tag(group_type: str) -> str:
    """A type as part of a column name, so that states of separate runs line up by type."""
    return re.sub(r"\W+", "_", group_type).strip("_")


def lookup(key: str, names: dict[str, str]) -> str:
    """SQL that replaces a key by its name."""
    entries = ", ".join(f"{C.literal(k)}, {C.literal(v)}" for k, v in names.items())
    return f"map({entries})[{key}]"


def present(names: list[str]) -> str:
    return "(" + " OR ".join(f"{n} IS NOT NULL" for n in names) + ")"


def value_columns(states: DataFrame, prefix: str = VALUE) -> list[str]:
    return sorted(c for c in states.columns if c.startswith(prefix))


def merge_frequency_states(states: DataFrame, by: list[str]) -> DataFrame:
    keys = [*map(C.quoted, by), COLUMN, *value_columns(states)]
    return states.groupBy(*keys).agg(F.sum(COPIES).alias(COPIES))


def frequency_summary(states: DataFrame, by: list[str]) -> DataFrame:
    """One row per group and column; the sums need no second look at the total row count."""
    filled = present(value_columns(states))
    sums = {
        "__rows": f"sum({COPIES})",
        "__present": f"sum(IF({filled}, {COPIES}, NULL))",
        "__distinct": f"count_if({filled})",
        "__once": f"count_if({filled} AND {COPIES} = 1)",
        "__copies_ln": f"sum(IF({filled}, {COPIES} * ln({COPIES}), NULL))",
    }
    return states.groupBy(*map(C.quoted, by), COLUMN).agg(
        *[F.expr(f"{sql} AS `{name}`") for name, sql in sums.items()]
    )


def frequency_results(
    summary: DataFrame, by: list[str], metrics: list[Metric], groups: DataFrame | None = None
) -> DataFrame:
    """The requested metrics of every group and column as long result rows.

    Groups listed in ``groups`` get their rows even if they have no data, and so does an
    empty input without grouping columns.
    """
    wanted = [m for m in metrics if m.kind in FREQUENCY]
    names = list(dict.fromkeys(m.columns[0] for m in wanted))
    summary = fill_groups(summary, by, COLUMN, names, groups)
    rows, distinct = "coalesce(__rows, 0)", "coalesce(__distinct, 0)"
    values = {
        "CountDistinct": distinct,
        "Distinctness": f"try_divide({distinct}, {rows})",
        # -sum(c/N * ln(c/N)) with c/N taken apart, so that N is not needed while counting.
        "Entropy": "try_divide(__present * ln(__rows) - __copies_ln, __rows)",
        "UniqueValueRatio": f"try_divide(__once, {distinct})",
        "Uniqueness": f"try_divide(__once, {rows})",
    }
    reason = f"IF({rows} = 0, 'empty', 'no non-null values')"
    kinds = list(dict.fromkeys(m.kind for m in wanted))
    template = [result_struct(Metric(k, ("",)), k, values[k], reason) for k in kinds]
    keys = [C.quoted(b) for b in by]
    asked = ", ".join(C.literal(f"{m.kind}:{m.columns[0]}") for m in wanted)
    return (
        result_rows(summary, [*keys, COLUMN], template)
        .where(f"concat(name, ':', {COLUMN}) IN ({asked})")
        .selectExpr(*keys, "entity", f"{COLUMN} AS instance", "name", "value", "reason")
    )


def fill_groups(
    summary: DataFrame, by: list[str], key: str, names: list[str], groups: DataFrame | None
) -> DataFrame:
    """Give every expected group one row for each name too, with nulls where nothing was counted."""
    if by and groups is None:
        return summary
    if not by:
        asked = local_table(summary.sparkSession, f"{key} string", [(n,) for n in names])
        return asked.join(summary, key, "left")
    listed = F.explode(F.array(*map(F.lit, names))).alias(key)
    asked = groups.select(*map(C.quoted, by)).distinct().select(*map(C.quoted, by), listed)
    return summary.unionByName(without_rows(asked, summary, [*by, key]), allowMissingColumns=True)
