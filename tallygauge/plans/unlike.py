"""Files with unlike columns read as one table.

Layouts that do not contradict each other (no column with two types or two spellings) are read
together with the union of their columns. A column a file does not have is null in its rows, and the
metrics that need it are replaced, for that file, by the failure they would have had alone.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions import columns as C
from tallygauge.functions.local import local_table
from tallygauge.functions.predicates import add_predicates
from tallygauge.operators.inputs import Inputs
from tallygauge.sources.files import SOURCE_PATH, literal_path
from tallygauge.spec import Metric


@dataclass(frozen=True)
class Layout:
    """The columns of some files; ``paths`` are as ``__source_path`` has them, by file name."""

    paths: dict[str, str]
    columns: T.StructType


def csv_columns(header: str, options: Mapping[str, object]) -> T.StructType | None:
    """The columns a header line names, or None if it needs the CSV reader's own rules."""
    given = {k.lower(): v for k, v in options.items()}
    if set(given) - {"header", "sep", "delimiter", "quote", "escape", "nullvalue", "mode"}:
        return None
    separator, quote = given.get("sep", given.get("delimiter", ",")), given.get("quote", '"')
    if len(str(separator)) != 1 or len(str(quote)) != 1:
        return None
    names = next(csv.reader([header], delimiter=separator, quotechar=quote))
    if not all(names) or len({n.lower() for n in names}) != len(names):
        return None
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def compatible(layouts: Iterable[Layout]) -> list[list[Layout]]:
    """The layouts in as few groups as a first fit gives, none of which contradicts itself."""
    groups: list[tuple[dict[str, tuple[str, T.DataType]], list[Layout]]] = []
    for layout in layouts:
        own = {f.name.lower(): (f.name, f.dataType) for f in layout.columns.fields}
        for known, members in groups:
            if all(known.get(k, v) == v for k, v in own.items()):
                known.update(own)
                members.append(layout)
                break
        else:
            groups.append((dict(own), [layout]))
    return [members for _, members in groups]


def union_of(layouts: Iterable[Layout]) -> T.StructType:
    fields = {f.name: f for layout in layouts for f in layout.columns.fields}
    return T.StructType(list(fields.values()))


def read_together(
    spark: SparkSession,
    layouts: list[Layout],
    files: list[str],
    file_format: str,
    options: Mapping[str, object],
) -> DataFrame:
    """One frame over all files of compatible layouts, with ``__source_path``."""
    paths = [literal_path(p) for p in files]
    union = union_of(layouts)
    source = F.col("_metadata.file_path").alias(SOURCE_PATH)
    reader = spark.read.options(**dict(options))
    if file_format == "json":
        return reader.schema(union).json(paths).select("*", source)
    # Cells are read by position; where a column stands in a file is a small table of the files.
    width = max(len(layout.columns) for layout in layouts)
    cells = T.StructType([T.StructField(f"__{i}", T.StringType()) for i in range(width)])
    rows = reader.option("header", True).schema(cells).csv(paths).select("*", source)
    places = []
    for layout in layouts:
        at = {n: i for i, n in enumerate(layout.columns.names)}
        text = ",".join(str(at.get(n, -1)) for n in union.names)
        places += [(path, text) for path in layout.paths.values()]
    known = local_table(spark, f"{SOURCE_PATH} string, places string", places)
    known = known.select(SOURCE_PATH, F.split("places", ",").cast("array<int>").alias("__at"))
    every = F.array(*cells.names)
    named = [F.get(every, F.get("__at", F.lit(i))).alias(n) for i, n in enumerate(union.names)]
    return rows.join(known, SOURCE_PATH).select(*named, SOURCE_PATH)


def needed_columns(data: DataFrame, inputs: Inputs, optional: set[str]) -> dict[str, list[tuple[Metric, str]]]:
    """The metrics that need each optional column, with the reason a file without it gets."""
    needs: dict[str, list[tuple[Metric, str]]] = {}
    rules: dict[str, Metric] = {}
    for metric in inputs.metrics:
        if metric in inputs.refused:
            continue
        if metric.kind == "Compliance":
            rules[f"__p{len(rules)}"] = metric
        for name in metric.columns:
            field = C.find_field(data.schema, name)
            if field is not None and field.name in optional:
                needs.setdefault(field.name, []).append((metric, f"unknown column {name}"))
    for column in sorted(optional):
        asked = {n: m for n, m in rules.items() if column.lower() in m.expression.lower()}
        if asked:
            without = data.drop(F.col(C.quoted(column)))
            _, bad = add_predicates(without, {n: m.expression for n, m in asked.items()})
            for name, reason in bad.items():
                needs.setdefault(column, []).append((asked[name], reason))
    return needs


def with_absent(results: DataFrame, data: DataFrame, inputs: Inputs, layouts: list[Layout]) -> DataFrame:
    """Results by ``file_name``, with failures where a file does not have what a metric needs."""
    every = union_of(layouts).names
    optional = {n for n in every if any(n not in layout.columns.names for layout in layouts)}
    needs = needed_columns(data, inputs, optional)
    if not needs:
        return results
    spark = results.sparkSession
    files = [(name, str(i)) for i, layout in enumerate(layouts) for name in layout.paths]
    absent = [(str(i), c) for i, layout in enumerate(layouts) for c in needs if c not in layout.columns.names]
    reasons = [(c, m.entity, m.instance, m.name, m.kind, why) for c, found in needs.items() for m, why in found]
    failed = (
        local_table(spark, "file_name string, layout string", files)
        .join(local_table(spark, "layout string, missing string", absent), "layout")
        .join(
            local_table(
                spark,
                "missing string, entity string, instance string, name string, kind string, reason string",
                reasons,
            ),
            "missing",
        )
        .groupBy("file_name", "entity", "instance", "name", "kind")
        .agg(F.max("reason").alias("reason"))
    )
    kind = F.when(F.col("name").startswith("Histogram."), F.lit("DataType")).otherwise(F.col("name"))
    shown = F.when(F.col("kind") == "DataType", F.lit("DataType")).otherwise(F.col("name"))
    gone = failed.select("file_name", "instance", shown.alias("shown"))
    kept = results.withColumn("shown", kind).join(gone, ["file_name", "instance", "shown"], "left_anti")
    rows = failed.withColumn("value", F.lit(None).cast("double"))
    return kept.drop("shown").select(results.columns).unionByName(rows.select(results.columns))
