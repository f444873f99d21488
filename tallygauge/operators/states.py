"""Metric states that are stored and merged later without reading the data again.

The three tables hold what the three passes of a profile produce before their last step.
Adding the states of new files to those already stored gives the metrics of everything.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygauge.operators.frequency import (
    COLUMN,
    frequency_results,
    frequency_states,
    frequency_summary,
    merge_frequency_states,
)
from tallygauge.operators.inputs import prepare
from tallygauge.operators.joint import (
    PAIR,
    joint_results,
    joint_states,
    joint_summary,
    merge_joint_states,
)
from tallygauge.operators.scan import merge_scan_states, scan_results, scan_states
from tallygauge.spec import FREQUENCY, JOINT, Metric, distinct_metrics


@dataclass
class States:
    """Mergeable states at the grain of their grouping columns.

    ``refused`` gives the reason by instance and name for metrics that have no state.
    """

    scan: DataFrame
    frequency: DataFrame | None
    joint: DataFrame | None
    refused: dict[tuple[str, str], str]


def compute_states(
    df: DataFrame,
    metrics: Iterable[Metric],
    by: Iterable[str | Column] = (),
    coerce_numeric: bool = False,
) -> States:
    inputs = prepare(df, metrics, by, coerce_numeric)
    return States(
        scan_states(inputs, mergeable=True),
        frequency_states(inputs),
        joint_states(inputs),
        {(m.instance, m.name): reason for m, reason in inputs.refused.items()},
    )


def results_from_states(states: States, metrics: Iterable[Metric], by: Iterable[str] = ()) -> DataFrame:
    """Merge states to the grain of ``by`` and finish ``metrics`` as long result rows."""
    by, metrics = list(by), distinct_metrics(metrics)
    reasons = {m: states.refused.get((m.instance, m.name)) for m in metrics}
    refused = {m: reason for m, reason in reasons.items() if reason}
    kept = [m for m in metrics if m not in refused]
    scan = merge_scan_states(states.scan, by)
    parts = [scan_results(scan, by, metrics, refused)]
    columns = list(dict.fromkeys(m.columns[0] for m in kept if m.kind in FREQUENCY))
    if columns and states.frequency is not None:
        asked = states.frequency.where(F.col(COLUMN).isin(columns))
        summary = frequency_summary(merge_frequency_states(asked, by), by)
        parts.append(frequency_results(summary, by, kept))
    instances = [m.instance for m in kept if m.kind in JOINT]
    if instances and states.joint is not None:
        asked = states.joint.where(F.col(PAIR).isin(instances))
        summary = joint_summary(merge_joint_states(asked, by), by)
        parts.append(joint_results(summary, by, kept))
    return reduce(DataFrame.unionByName, parts)
