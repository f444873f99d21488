"""Keys of the metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of a stored metric row, in output order.
METRIC_COLUMNS = (
    "entity",
    "instance",
    "name",
    "value",
    "bucket_file_name",
    "col_metricName",
    "bucket_name",
    "file_name",
)

# One stored row per file and metric. The two display keys join names with a dash and can
# read alike for different files, so rows are told apart by the names themselves.
ROW_KEY = ("bucket_name", "file_name", "instance", "name")


def with_keys(metrics: DataFrame) -> DataFrame:
    """Add ``bucket_file_name`` and ``col_metricName`` to rows that name their bucket and file."""
    return metrics.withColumns(
        {
            "bucket_file_name": F.concat_ws("-", "bucket_name", "file_name"),
            "col_metricName": F.concat_ws("-", "instance", "name"),
        }
    )
