"""Distinct and unique values from a sample of bounded size that merges exactly.

Of every group and column the ``k`` values with the smallest hashes are kept, with how often each occurs. A value that is among
the ``k`` smallest of all rows is among the ``k`` smallest of every part it is in, so its copies add up exactly when parts are
merged, whatever the parts are: states of files, days or tasks give the same sample as one pass over all rows.

Columns with fewer than ``k`` values are counted exactly. For the others the place of the ``k``-th hash tells how many values there
are, and the share of the kept values that occur once tells how many are unique; both come with bounds at ``SPREAD``
standard errors. Values are told apart by 64-bit hashes, an error far below the bounds. Only hashes leave the scan, never values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions import columns as C
from tallygauge.functions.local import local_table
from tallygauge.operators.frequency import COLUMN, COPIES
from tallygauge.operators.inputs import Inputs, prepare
from tallygauge.spec import Metric, distinct_metrics

SAMPLED = ("CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio")
#: Up to 1,000 (``spark.sql.optimizer.windowGroupLimitThreshold``) Spark also cuts the ranked rows before it shuffles them.
KEPT = 1000
SPREAD = 4.0
HASH, FILLED, SIZE = "__hash", "__filled", "__kept"
#: Rows a task holds before it hands its partial samples on, and ranges a group's hashes are ranked in first.
ROWS_HELD = 1_000_000
RANGES = 32


def sample_states(
    df: DataFrame, metrics: Iterable[Metric], by: Iterable[str | Column] = (), k: int = KEPT
) -> DataFrame:
    """At most ``k`` values per group and column with their copies, and a row with the totals under a null hash."""
    metrics = distinct_metrics(metrics)
    if k < 64:
        raise ValueError("a sample needs 64 values or more")
    inputs = prepare(df, metrics, by)
    refused = {m: why for m in metrics if (why := problem(m, inputs))}
    if refused:
        raise ValueError("; ".join(f"{m.kind} of {m.instance}: {why}" for m, why in refused.items()))
    keys = [f"k{i}" for i in range(len(inputs.by))]
    hashes = {name: f"h{i}" for i, name in enumerate(inputs.columns)}
    plain = inputs.base.selectExpr(
        *[f"{C.quoted(b)} AS {k}" for b, k in zip(inputs.by, keys)],
        *[f"{value_hash(inputs.cell(n), inputs.types[n])} AS {h}" for n, h in hashes.items()],
    )
    counts = [T.StructField(n, T.LongType()) for n in (HASH, COPIES, FILLED)]
    schema = T.StructType([*(plain.schema[k] for k in keys), T.StructField(COLUMN, T.StringType()), *counts])
    parts = plain.mapInArrow(partial_samples(keys, hashes, k), schema)
    named = parts.select(*[F.col(k).alias(b) for b, k in zip(inputs.by, keys)], COLUMN, HASH, COPIES, FILLED)
    return merge_sample_states(named.withColumn(SIZE, F.lit(k)), inputs.by, k)


def value_hash(cell: str, dtype: T.DataType) -> str:
    return f"IF({cell} IS NULL, NULL, xxhash64({C.sketch_value(cell, dtype)}))"


def problem(metric: Metric, inputs: Inputs) -> str | None:
    if metric.kind not in SAMPLED:
        return "not a metric of samples"
    if metric in inputs.refused:
        return inputs.refused[metric]
    dtype = inputs.types[metric.columns[0]]
    if isinstance(dtype, T.StringType) and dtype.collation != "UTF8_BINARY":
        return "hashes tell texts apart that its collation makes equal"
    return None


def partial_samples(keys: list[str], hashes: dict[str, str], k: int):
    """The samples of one task: one per group and measured column, cut to ``k`` after every batch."""
    order = [*keys, HASH, COPIES, FILLED]

    def added(table: pa.Table, by: list[str], sums: list[tuple]) -> pa.Table:
        return table.group_by(by, use_threads=False).aggregate(sums).rename_columns([*by, COPIES, FILLED])

    def smallest(table: pa.Table) -> pa.Table:
        if table.num_rows <= k:
            return table
        codes = [pc.dictionary_encode(table[c].combine_chunks(), null_encoding="encode").indices.to_numpy() for c in keys]
        rank = np.lexsort((table[HASH].to_numpy(), *codes))
        new = np.zeros(len(rank), dtype=bool)
        new[0] = True
        for code in codes:
            new[1:] |= np.diff(code[rank]) != 0
        firsts = np.flatnonzero(new)
        place = np.arange(len(rank)) - np.repeat(firsts, np.diff(np.append(firsts, len(rank))))
        return table.take(pa.array(rank[place < k]))

    def merged(held: pa.Table | None, own: pa.Table, by: list[str]) -> pa.Table:
        if held is None:
            return own
        return added(pa.concat_tables([held, own]), by, [(COPIES, "sum"), (FILLED, "sum")])

    def rows(values: dict, totals: dict) -> Iterator[pa.RecordBatch]:
        for name in values:
            nothing = pa.nulls(totals[name].num_rows, pa.int64())
            total = totals[name].append_column(HASH, nothing).select(order)
            whole = pa.concat_tables([values[name].select(order), total])
            label = pa.array([name] * whole.num_rows, pa.string())
            yield from whole.add_column(len(keys), COLUMN, label).combine_chunks().to_batches()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, totals = {}, {}
        for batch in batches:
            for name, column in hashes.items():
                table = pa.table([*(batch.column(c) for c in keys), batch.column(column)], names=[*keys, HASH])
                sums = [([], "count_all"), (HASH, "count")]
                if keys:
                    total = added(table, keys, sums)
                else:
                    total = pa.table({COPIES: [table.num_rows], FILLED: [table.num_rows - table[HASH].null_count]})
                own = added(table.filter(pc.is_valid(table[HASH])), [*keys, HASH], sums)
                values[name] = smallest(merged(values.get(name), own, [*keys, HASH]))
                if keys or name not in totals:
                    totals[name] = merged(totals.get(name), total, keys)
                else:
                    held = totals[name]
                    totals[name] = pa.table({c: pc.add(held[c], total[c]) for c in (COPIES, FILLED)})
            if sum(t.num_rows for t in (*values.values(), *totals.values())) > ROWS_HELD:
                yield from rows(values, totals)
                values, totals = {}, {}
        yield from rows(values, totals)

    return partial


def merge_sample_states(states: DataFrame, by: Iterable[str], k: int = KEPT) -> DataFrame:
    """One sample per ``by`` group and column out of stored ones, which have to be of ``k`` values or more.

    Hashes are spread evenly, so the values of one group are added up and cut in many tasks before the last cut.
    """
    keys = [*map(C.quoted, by), COLUMN]
    kept = F.min(SIZE)
    least = F.when(kept >= k, F.lit(k)).otherwise(F.raise_error(F.lit(f"a stored sample has fewer than {k} values")).cast("int"))
    added = states.groupBy(*keys, HASH).agg(
        F.sum(COPIES).alias(COPIES), F.sum(FILLED).alias(FILLED), least.alias(SIZE)
    )
    total = F.col(HASH).isNull()
    for group in ([F.pmod(HASH, F.lit(RANGES))], [total]):
        ranked = Window.partitionBy(*keys, *group).orderBy(HASH)
        added = added.withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") <= k).drop("__rank")
    return added


def sample_results(states: DataFrame, metrics: Iterable[Metric], by: Iterable[str] = (), k: int = KEPT) -> DataFrame:
    """The metrics with ``low`` and ``high``; where all values are in the sample, both equal the value.

    The denominator is all rows. A ratio of no rows, or of no values, is null.
    """
    by, metrics = list(by), distinct_metrics(metrics)
    merged = merge_sample_states(states, by, k)
    keys = [*map(C.quoted, by), COLUMN]
    found = merged.groupBy(*keys).agg(
        F.sum(F.when(F.col(HASH).isNull(), F.col(COPIES))).alias("n"),
        F.sum(F.when(F.col(HASH).isNull(), F.col(FILLED))).alias("filled"),
        F.count(HASH).alias("s"),
        F.max(HASH).alias("top"),
        F.count_if(F.col(HASH).isNotNull() & (F.col(COPIES) == 1)).alias("once"),
        F.max_by(COPIES, HASH).alias("last_copies"),
    )
    if not by:
        names = [(n,) for n in dict.fromkeys(m.columns[0] for m in metrics)]
        found = local_table(states.sparkSession, f"{COLUMN} string", names).join(found, COLUMN, "left")
    found = found.fillna(0, ["n", "filled", "s", "once"])
    z, trials = SPREAD, k - 1
    # The last kept hash only marks how far the sample reaches; the values below it are drawn evenly.
    share = f"((once - IF(last_copies = 1, 1, 0)) / {trials}D)"
    reach = "((CAST(top AS DOUBLE) + 9223372036854775809D) / 18446744073709551616D)"
    middle, scale = f"({share} + {z * z / (2 * trials)}D)", f"{1 + z * z / trials}D"
    width = f"{z}D * sqrt({share} * (1D - {share}) / {trials}D + {z * z / (4 * trials * trials)}D)"
    whole = f"s < {k}"
    found = found.selectExpr(
        *keys,
        "CAST(n AS DOUBLE) AS n",
        f"IF({whole}, s, {k - 1}D / {reach}) AS d",
        f"IF({whole}, s, greatest({k}D, {k - z * sqrt(k)}D / {reach})) AS d_low",
        f"IF({whole}, s, least(filled, {k + z * sqrt(k)}D / {reach})) AS d_high",
        f"IF({whole}, try_divide(once, s), {share}) AS u",
        f"IF({whole}, try_divide(once, s), IF({share} = 0, 0D, ({middle} - {width}) / {scale})) AS u_low",
        f"IF({whole}, try_divide(once, s), IF({share} = 1, 1D, ({middle} + {width}) / {scale})) AS u_high",
        f"IF({whole}, CAST(once AS DOUBLE), NULL) AS once",
    )
    values = {
        "CountDistinct": ("d", "d_low", "d_high"),
        "Distinctness": tuple(f"try_divide({c}, n)" for c in ("d", "d_low", "d_high")),
        "UniqueValueRatio": ("u", "u_low", "u_high"),
        "Uniqueness": tuple(f"try_divide(coalesce(once, d{c} * u{c}), n)" for c in ("", "_low", "_high")),
    }
    rows = [
        f"struct('{kind}' AS name, CAST({v} AS DOUBLE) AS value, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high)"
        for kind, (v, low, high) in values.items()
    ]
    asked = [f"{m.kind}:{m.columns[0]}" for m in metrics]
    long = found.selectExpr(*keys, f"inline(array({', '.join(rows)}))")
    return long.where(F.concat("name", F.lit(":"), COLUMN).isin(asked)).selectExpr(
        *keys[:-1], "'Column' AS entity", f"{COLUMN} AS instance", "name", "value", "low", "high"
    )
