"""Bounds for a metric learned from its own history.

Every series (a metric of one group) carries a small state from run to run: an exponentially weighted mean and spread of its values,
or of their differences to the run one season before. A run is held against the bounds of the runs before it, then learned.

``learned_bounds`` replays a whole history: series are spread over tasks, and a task reads its own in order with one state in
memory, however many runs there are. ``check_run`` takes the last states and a new run, and reads no history at all.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import isnan, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions.columns import quoted
from tallygauge.operators.history import RUN, SERIES

STATE = ("seen", "mean", "variance", "recent")
ADDED = T.StructType(
    [
        *(T.StructField(n, T.DoubleType()) for n in ("expected", "low", "high")),
        T.StructField("broken", T.BooleanType()),
        T.StructField("seen", T.LongType()),
        *(T.StructField(n, T.DoubleType()) for n in ("mean", "variance")),
        T.StructField("recent", T.ArrayType(T.DoubleType())),
    ]
)
#: Part of the expected value by which sums in another order may differ.
SLACK = 1e-9


@dataclass(frozen=True)
class Learning:
    """``weight`` of the newest run, ``spread`` in standard deviations, runs before the first verdict, runs of a season (0: none)."""

    weight: float = 0.3
    spread: float = 3.0
    warm_up: int = 5
    season: int = 0

    def __post_init__(self):
        if not (0 < self.weight <= 1 and self.spread > 0 and self.warm_up > 0 and self.season >= 0):
            raise ValueError("weight is in (0, 1], spread and warm-up above 0, a season 0 or more")


def learned_bounds(
    history: DataFrame, learning: Learning = Learning(), order: str = RUN, by: Iterable[str] = ()
) -> DataFrame:
    """The history with ``expected``, ``low``, ``high``, ``broken`` and the state of the series after each run.

    A run without a value (null or NaN) is not judged and not learned. ``broken`` is null as long as there are no bounds.
    """
    if clash := set(ADDED.names) & set(history.columns):
        raise ValueError(f"a history cannot have a column {sorted(clash)}")
    keys = [quoted(k) for k in (*by, *SERIES)]
    series = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    ordered = (
        history.select(series.alias("__series"), F.col("value").cast("double").alias("__value"), "*")
        .repartition("__series")
        .sortWithinPartitions("__series", quoted(order), "__value")
    )
    return ordered.mapInArrow(replay(learning), T.StructType([*history.schema.fields, *ADDED.fields]))


def replay(learning: Learning):
    """Runs of many series, each in order, to the same rows with bounds and states."""
    weight, spread, season = learning.weight, learning.spread, learning.season

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            added: dict[str, list] = {n: [] for n in ADDED.names}
            for series, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if series != current:
                    current, seen, mean, variance, recent = series, 0, 0.0, 0.0, deque(maxlen=season)
                value = None if value is None or isnan(value) else value
                base = (recent[0] if len(recent) == season else None) if season else 0.0
                expected = low = high = broken = None
                if seen >= learning.warm_up and base is not None:
                    expected = base + mean
                    width = spread * sqrt(variance) + SLACK * abs(expected)
                    low, high = expected - width, expected + width
                    broken = None if value is None else not low <= value <= high
                if value is not None and base is not None:
                    off = value - base - mean
                    if seen:
                        mean += weight * off
                        variance = (1 - weight) * (variance + weight * off * off)
                    else:
                        mean = value - base
                    seen += 1
                recent.append(value)
                row = (expected, low, high, broken, seen, mean, variance, list(recent))
                for name, cell in zip(added, row):
                    added[name].append(cell)
            columns = [pa.array(added[f.name], arrow_type(f)) for f in ADDED.fields]
            kept = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *columns], names=[*kept, *ADDED.names])

    return judged


def arrow_type(field: T.StructField) -> pa.DataType:
    types = {"double": pa.float64(), "boolean": pa.bool_(), "bigint": pa.int64()}
    return types.get(field.dataType.simpleString(), pa.list_(pa.float64()))


def last_states(judged: DataFrame, order: str = RUN, by: Iterable[str] = ()) -> DataFrame:
    """The state of every series after its last run, which is all a new run needs."""
    keys = [quoted(k) for k in (*by, *SERIES)]
    state = F.struct(*STATE)
    return judged.groupBy(*keys).agg(F.max_by(state, quoted(order)).alias("__last")).select(*keys, "__last.*")


def check_run(
    states: DataFrame, metrics: DataFrame, learning: Learning = Learning(), by: Iterable[str] = ()
) -> DataFrame:
    """A new run held against the states of the runs before, with bounds and new states as in ``learned_bounds``.

    Metrics that have no state yet begin one. The states of series that the run lacks are not in the result.
    """
    if clash := set(ADDED.names) & set(metrics.columns):
        raise ValueError(f"a run cannot have a column {sorted(clash)}")
    keys = [*by, *SERIES]
    names = [f"__k{i}" for i in range(len(keys))]
    held = states.select(*[F.col(quoted(k)).alias(n) for k, n in zip(keys, names)], F.struct(*STATE).alias("__s"))
    same = reduce(lambda a, b: a & b, [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    w, season = learning.weight, learning.season
    base = f"IF(size(__recent) = {season}, __recent[0], NULL)" if season else "0D"
    steps = [
        {"__x": "nanvl(CAST(value AS DOUBLE), NULL)", "__recent": "coalesce(__s.recent, CAST(array() AS ARRAY<DOUBLE>))",
         "__seen": "coalesce(__s.seen, 0L)", "__mean": "coalesce(__s.mean, 0D)", "__var": "coalesce(__s.variance, 0D)"},
        {"__base": base, "__off": f"__x - {base} - __mean"},
        {"expected": f"IF(__seen >= {learning.warm_up}, __base + __mean, NULL)"},
        {"__width": f"{learning.spread}D * sqrt(__var) + {SLACK}D * abs(expected)"},
        {"low": "expected - __width", "high": "expected + __width"},
        {"broken": "__x < low OR __x > high"},
        {
            "seen": "__seen + IF(__off IS NULL, 0L, 1L)",
            "mean": f"CASE WHEN __off IS NULL THEN __mean WHEN __seen = 0 THEN __x - __base ELSE __mean + {w}D * __off END",
            "variance": f"IF(__off IS NULL OR __seen = 0, __var, {1 - w}D * (__var + {w}D * __off * __off))",
            "recent": f"slice(concat(__recent, array(__x)), -least({season}, size(__recent) + 1), {season})" if season else "__recent",
        },
    ]
    rows = metrics.join(held, same, "left")
    for step in steps:
        rows = rows.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return rows.select(*map(quoted, metrics.columns), *ADDED.names)
