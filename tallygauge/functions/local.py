"""Small tables made on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW_TYPES = {T.StringType(): pa.string(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}


def local_table(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A table of text, bigint and double columns whose size Spark knows.

    A frame made from Python rows has no known size and is never small to the optimizer; one made
    from Arrow data is, so Spark can send it to the other side of a join.
    """
    fields = T.StructType.fromDDL(schema).fields
    columns = [
        pa.array([row[i] for row in rows], ARROW_TYPES[field.dataType])
        for i, field in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(columns, names=[f.name for f in fields]))
