"""Which rules each row breaks, and how many rows keep each rule, in one pass over the rows.

A rule is a predicate as Compliance takes it. A row breaks a rule whose predicate is false or null for it. The shares are
gathered by an observation while the rows are written, so nothing is read a second time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallygauge.functions import columns as C
from tallygauge.functions.local import local_table
from tallygauge.functions.predicates import add_predicates
from tallygauge.spec import Metric, distinct_metrics

BROKEN = "broken_rules"
RESULT = "entity string, instance string, name string, value double, reason string"


@dataclass
class Verdicts:
    """``rows`` has all columns and ``broken_rules``; ``compliance`` can be asked for once ``rows`` were written."""

    rows: DataFrame
    rules: list[Metric]
    refused: dict[Metric, str]
    observation: Observation

    def compliance(self) -> DataFrame:
        """Compliance of every rule as result rows, waiting for ``rows`` to be written or collected."""
        counts = self.observation.get
        total = counts["rows"]
        out = []
        for i, rule in enumerate(self.rules):
            reason = self.refused.get(rule) or (None if total else "empty")
            value = None if reason else counts[f"kept_{i}"] / total
            out.append((rule.entity, rule.instance, rule.name, value, reason))
        return local_table(self.rows.sparkSession, RESULT, out)


def judge(df: DataFrame, rules: Iterable[Metric]) -> Verdicts:
    """``df`` with the names of the rules that each row breaks, in the order of the rules; none is an empty list."""
    if BROKEN in (c.lower() for c in df.columns):
        raise ValueError(f"rows cannot have a column {BROKEN}")
    rules = [m for m in distinct_metrics(rules) if m.kind == "Compliance"]
    prefix = "__rule"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    names = {f"{prefix}{i}": m for i, m in enumerate(rules)}
    tested, bad = add_predicates(df, {n: m.expression for n, m in names.items()})
    kept = {n: F.coalesce(F.col(n), F.lit(False)) for n in names if n not in bad}
    breaks = [F.when(~is_kept, F.lit(names[n].instance)) for n, is_kept in kept.items()]
    listed = F.filter(F.array(*breaks), lambda x: x.isNotNull()) if breaks else F.array().cast("array<string>")
    observation = Observation()
    sums = [F.count_if(is_kept).alias(f"kept_{list(names).index(n)}") for n, is_kept in kept.items()]
    observed = tested.observe(observation, F.count(F.lit(1)).alias("rows"), *sums)
    rows = observed.select(*(F.col(C.quoted(c)) for c in df.columns), listed.alias(BROKEN))
    return Verdicts(rows, rules, {names[n]: reason for n, reason in bad.items()}, observation)


def write_split(df: DataFrame, rules: Iterable[Metric], path: str) -> DataFrame:
    """Write all rows below ``path``, those that break a rule in ``broken=true`` and the others in ``broken=false``.

    Returns the Compliance of the rules. The rows are read once.
    """
    verdicts = judge(df, rules)
    rows = verdicts.rows.withColumn("broken", F.size(BROKEN) > 0)
    rows.write.partitionBy("broken").mode("overwrite").parquet(path)
    return verdicts.compliance()
