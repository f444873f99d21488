"""Mutual information of column pairs from joint frequencies.

All pairs share one pass that counts ``(group, pair, a, b)``. The marginals come from that table,
not from the data. The usual join of every pair with both marginals is not needed: with
N rows, c copies of a pair and n copies of a value,

    sum c/N ln((c/N) / (n_a/N n_b/N)) = (sum c ln c + C ln N - sum c_a ln n_a - sum c_b ln n_b) / N

where C counts rows with both values and c_a those of them that hold the value a. Each
term is a plain sum over a frequency table, so no value is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.functions import columns as C
from tallygauge.operators.frequency import (
    COPIES,
    expand,
    fill_groups,
    lookup,
    present,
    type_tag,
    value_columns,
)
from tallygauge.operators.inputs import Inputs, result_rows, result_struct
from tallygauge.spec import JOINT, Metric

PAIR, LEFT, RIGHT = "__pair", "__a_", "__b_"


def joint_states(inputs: Inputs) -> DataFrame | None:
    """The joint frequency table: grouping columns, the pair, typed a and b values, their copies."""
    metrics = inputs.of(JOINT)
    if not metrics:
        return None
    names = list(dict.fromkeys(n for m in metrics for n in m.columns))
    families = list(dict.fromkeys(C.group_type(inputs.types[n]) for n in names))
    cells = {
        f"v{i}": C.group_value(inputs.cell(n), inputs.types[n]) for i, n in enumerate(names)
    }

    def cells_of(name: str) -> list[str]:
        own = families.index(C.group_type(inputs.types[name]))
        return [
            f"v{names.index(name)}" if f == own else f"null{f}" for f in range(len(families))
        ]

    sets = [cells_of(m.columns[0]) + cells_of(m.columns[1]) for m in metrics]
    outputs = [side + type_tag(t) for side in (LEFT, RIGHT) for t in families]
    long = expand(inputs, cells, families, sets, outputs)
    counted = long.groupBy(*map(C.quoted, inputs.by), "__set", *outputs).agg(
        F.count(F.lit(1)).alias(COPIES)
    )
    pair = lookup("__set", {str(i): m.instance for i, m in enumerate(metrics)})
    return counted.selectExpr(*map(C.quoted, inputs.by), f"{pair} AS {PAIR}", *outputs, COPIES)


def merge_joint_states(states: DataFrame, by: list[str]) -> DataFrame:
    values = value_columns(states, LEFT) + value_columns(states, RIGHT)
    keys = [*map(C.quoted, by), PAIR, *values]
    return states.groupBy(*keys).agg(F.sum(COPIES).alias(COPIES))


def joint_summary(states: DataFrame, by: list[str]) -> DataFrame:
    """One row per group and pair with the terms of the formula above.

    The table is read once: every joint count goes to both its marginals and, under the side
    ``ab`` with no value, to the totals of its pair.
    """
    left, right = value_columns(states, LEFT), value_columns(states, RIGHT)
    keys = [*map(C.quoted, by), PAIR]
    filled = f"{present(left)} AND {present(right)}"
    tagged = states.selectExpr(
        *keys,
        *left,
        *right,
        *[f"IF(false, {n}, NULL) AS {n}null" for n in left],
        COPIES,
        f"IF({filled}, {COPIES}, 0L) AS __both",
    )
    values = [f"__value_{i}" for i in range(len(left))]
    sides = ", ".join(
        f"({', '.join(cells)}) AS {side}"
        for side, cells in (("ab", [f"{n}null" for n in left]), ("a", left), ("b", right))
    )
    long = states.sparkSession.sql(
        f"SELECT * FROM {{tagged}} UNPIVOT INCLUDE NULLS (({', '.join(values)}) FOR __side IN ({sides}))",
        tagged=tagged,
    )
    marginals = (
        long.where(f"__side = 'ab' OR {present(values)}")
        .groupBy(*keys, "__side", *values)
        .agg(
            F.expr(f"sum({COPIES}) AS {COPIES}"),
            F.expr("sum(__both) AS __both"),
            F.expr("sum(IF(__side = 'ab' AND __both > 0, __both * ln(__both), NULL)) AS __both_ln"),
        )
    )
    return marginals.groupBy(*keys).agg(
        F.expr(f"sum(IF(__side = 'ab', {COPIES}, NULL)) AS __rows"),
        F.expr("sum(IF(__side = 'ab', __both, NULL)) AS __both"),
        F.expr(f"sum(IF(__side = 'ab', __both_ln, -__both * ln({COPIES}))) AS __term"),
    )


def joint_results(
    summary: DataFrame, by: list[str], metrics: list[Metric], groups: DataFrame | None = None
) -> DataFrame:
    wanted = [m for m in metrics if m.kind in JOINT]
    summary = fill_groups(summary, by, PAIR, [m.instance for m in wanted], groups)
    value = "IF(__both > 0, (__term + __both * ln(__rows)) / __rows, NULL)"
    reason = "IF(coalesce(__rows, 0) = 0, 'empty', 'no row has both values')"
    template = [result_struct(wanted[0], wanted[0].name, value, reason)]
    keys = [C.quoted(b) for b in by]
    return result_rows(summary, [*keys, PAIR], template).selectExpr(
        *keys, "entity", f"{PAIR} AS instance", "name", "value", "reason"
    )
