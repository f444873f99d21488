"""All metrics of a DataFrame, for each group, in three passes or a few more if it is wide."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygauge.operators.frequency import (
    frequency_results,
    frequency_states,
    frequency_summary,
)
from tallygauge.operators.inputs import Inputs, prepare
from tallygauge.operators.joint import joint_results, joint_states, joint_summary
from tallygauge.operators.scan import scan_passes, scan_results, scan_states
from tallygauge.spec import FREQUENCY, JOINT, Metric


@dataclass
class Profile:
    """Long results: grouping columns, entity, instance, name, value, reason.

    A row has either a value or the reason why there is none. ``metrics`` and ``failures``
    are views of the same plan: write ``results`` once and split the stored rows when both
    are needed.
    """

    results: DataFrame
    by: list[str]

    @property
    def metrics(self) -> DataFrame:
        return successes(self.results)

    @property
    def failures(self) -> DataFrame:
        return failures(self.results)


def successes(results: DataFrame) -> DataFrame:
    return results.where(F.col("value").isNotNull()).drop("reason")


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("value").isNull()).drop("value")


def profile(
    df: DataFrame,
    metrics: Iterable[Metric],
    by: Iterable[str | Column] = (),
    coerce_numeric: bool = False,
    groups: DataFrame | None = None,
) -> Profile:
    """Compute ``metrics`` on ``df`` for every distinct value of the ``by`` columns.

    Numeric metrics refuse text columns unless ``coerce_numeric`` is set, in which case
    text that is no number counts as null. ``groups`` may list the groups to expect, one row
    each with the ``by`` columns; those without data are reported as empty.
    """
    return profile_inputs(prepare(df, metrics, by, coerce_numeric), groups)


def passes(inputs: Inputs) -> int:
    """How often a profile reads its prepared rows."""
    return len(scan_passes(inputs)) + bool(inputs.of(FREQUENCY)) + bool(inputs.of(JOINT))


def profile_inputs(
    inputs: Inputs,
    groups: DataFrame | None = None,
    names: dict[str, Column] | None = None,
) -> Profile:
    """Profile prepared rows.

    ``names`` replaces the grouping columns by expressions over them that tell the same groups
    apart. They run on one row per group, where a grouping expression would run on every row.
    """
    by = list(names) if names else inputs.by

    def renamed(table: DataFrame) -> DataFrame:
        return table.withColumns(names).drop(*inputs.by) if names else table

    parts = []
    for i, metrics in enumerate(scan_passes(inputs)):
        states = renamed(scan_states(inputs, metrics=metrics))
        metrics = [*metrics, *inputs.refused] if i == 0 else metrics
        parts.append(scan_results(states, by, metrics, inputs.refused, groups=groups))
    frequency = frequency_states(inputs)
    if frequency is not None:
        summary = renamed(frequency_summary(frequency, inputs.by))
        parts.append(frequency_results(summary, by, inputs.of(FREQUENCY), groups))
    joint = joint_states(inputs)
    if joint is not None:
        summary = renamed(joint_summary(joint, inputs.by))
        parts.append(joint_results(summary, by, inputs.of(JOINT), groups))
    return Profile(reduce(DataFrame.unionByName, parts), by)
