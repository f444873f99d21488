"""Turn a DataFrame and a metric list into the narrow frame all passes read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions import columns as C
from tallygauge.functions.predicates import add_predicates, pattern_problem
from tallygauge.spec import FREQUENCY, JOINT, NUMERIC, Metric, distinct_metrics

RESULT_COLUMNS = ("entity", "instance", "name", "value", "reason")


@dataclass
class Inputs:
    """``base`` holds the grouping columns, one column per measured column, one per predicate."""

    base: DataFrame
    by: list[str]
    metrics: list[Metric]
    refused: dict[Metric, str]
    columns: dict[str, str] = field(default_factory=dict)
    types: dict[str, T.DataType] = field(default_factory=dict)
    predicates: dict[str, str] = field(default_factory=dict)

    def cell(self, name: str) -> str:
        """The column of ``base`` that holds the cells of a measured column."""
        return self.columns[name]

    def of(self, kinds: Iterable[str]) -> list[Metric]:
        return [m for m in self.metrics if m.kind in kinds and m not in self.refused]


def prepare(
    df: DataFrame,
    metrics: Iterable[Metric],
    by: Iterable[str | Column] = (),
    coerce_numeric: bool = False,
) -> Inputs:
    """Check every metric against the schema and select just the columns they need.

    A metric that cannot be computed lands in ``refused`` with the reason; it never stops
    the others.
    """
    metrics = distinct_metrics(metrics)
    by = [F.col(C.quoted(b)) if isinstance(b, str) else b for b in by]
    by_names = df.select(*by).columns if by else []
    clash = set(RESULT_COLUMNS) & set(by_names)
    if clash or len(set(by_names)) != len(by_names):
        raise ValueError(f"grouping columns must be distinct and not named {sorted(clash)}")

    refused: dict[Metric, str] = {}
    fields: dict[str, T.StructField] = {}
    for metric in metrics:
        for name in metric.columns:
            found = C.find_field(df.schema, name)
            if found is None:
                refused[metric] = f"unknown column {name}"
            else:
                fields[name] = found
        if metric not in refused:
            reason = type_problem(metric, [fields[n].dataType for n in metric.columns], coerce_numeric)
            if not reason and metric.kind == "PatternMatch":
                reason = pattern_problem(df.sparkSession, metric.expression)
            if reason:
                refused[metric] = reason

    rules = [m for m in metrics if m.kind == "Compliance"]
    names = {f"__p{i}": m for i, m in enumerate(rules)}
    tested, bad = add_predicates(df, {n: m.expression for n, m in names.items()})
    refused.update({names[n]: reason for n, reason in bad.items()})
    predicates = {m.label: n for n, m in names.items() if n not in bad}

    used = dict.fromkeys(n for m in metrics if m not in refused for n in m.columns)
    inner = {name: f"__c{i}" for i, name in enumerate(used)}
    base = tested.select(
        *by,
        *[F.col(C.quoted(fields[name].name)).alias(i) for name, i in inner.items()],
        *predicates.values(),
    )
    types = {name: fields[name].dataType for name in inner}
    return Inputs(base, by_names, metrics, refused, inner, types, predicates)


def type_problem(metric: Metric, dtypes: list[T.DataType], coerce_numeric: bool) -> str | None:
    """Why ``metric`` cannot be computed on columns of these types, or None."""
    for name, dtype in zip(metric.columns, dtypes):
        shown = f"column {name} is {dtype.simpleString()}"
        if metric.kind in NUMERIC:
            if not (C.is_numeric(dtype) or (coerce_numeric and isinstance(dtype, T.StringType))):
                return f"{shown}, not numeric"
        elif metric.kind in ("DataType", "PatternMatch"):
            if not C.is_atomic(dtype):
                return f"{shown}, not a plain value"
        elif metric.kind in FREQUENCY + JOINT + ("ApproxCountDistinct",):
            if not C.is_groupable(dtype):
                return f"{shown}, which cannot be grouped"
    return None


def result_struct(metric: Metric, name: str, value: str, reason: str) -> str:
    """SQL for one result row; ``reason`` is kept only where there is no value."""
    return (
        f"struct({C.literal(metric.entity)} AS entity, {C.literal(metric.instance)} AS instance, "
        f"{C.literal(name)} AS name, CAST({value} AS DOUBLE) AS value, "
        f"CASE WHEN ({value}) IS NULL THEN {reason} END AS reason)"
    )


def result_rows(table: DataFrame, keep: list[str], structs: list[str]) -> DataFrame:
    """Result rows of a table with one row per group; ``keep`` is SQL for the leading columns."""
    return table.selectExpr(*keep, f"inline(array({', '.join(structs)}))")
