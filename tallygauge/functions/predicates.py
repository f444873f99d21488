"""User predicates, evaluated so that bad cells count as "not compliant"."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygauge.functions.columns import literal

ANSI = "spark.sql.ansi.enabled"
# What an analyzed plan shows of expressions that need other rows than their own.
BEYOND_A_ROW = ("windowspecdefinition(", "scalar-subquery#", "exists#", "list#", "Generate ")


@contextmanager
def lenient_casts(spark: SparkSession):
    """Resolve expressions with casts that give null instead of raising.

    Spark fixes the mode of a cast or a division when it resolves the expression, so only
    columns selected inside the block are affected; the session setting is put back after.
    """
    before = spark.conf.get(ANSI)
    spark.conf.set(ANSI, "false")
    try:
        yield
    finally:
        spark.conf.set(ANSI, before)


def add_predicates(
    df: DataFrame, predicates: dict[str, str]
) -> tuple[DataFrame, dict[str, str]]:
    """Add one boolean column for each ``{column name: predicate}`` that Spark accepts.

    Returns the frame and, for the others, the reason they were refused.
    """
    accepted, refused = [], {}
    with lenient_casts(df.sparkSession):
        for name, predicate in predicates.items():
            try:
                column = F.expr(predicate).alias(name)
                tested = df.select("*", column)
                dtype = tested.schema[name].dataType
            except (ParseException, AnalysisException) as error:
                refused[name] = f"predicate refused: {error_class(error)}"
                continue
            if beyond_a_row(df, tested):
                refused[name] = "predicate looks beyond its row"
            elif isinstance(dtype, T.BooleanType):
                accepted.append(column)
            else:
                refused[name] = f"predicate is {dtype.simpleString()}, not boolean"
        return (df.select("*", *accepted) if accepted else df), refused


def beyond_a_row(df: DataFrame, tested: DataFrame) -> bool:
    """Whether a column was added that needs other rows: a window, a subquery, a generator."""
    plans = [frame._jdf.queryExecution().analyzed().toString() for frame in (df, tested)]
    return any(plans[1].count(mark) > plans[0].count(mark) for mark in BEYOND_A_ROW)


def pattern_problem(spark: SparkSession, pattern: str) -> str | None:
    """Why a regular expression is refused, or None; it is tried on one literal, in no task."""
    try:
        spark.sql(f"SELECT '' RLIKE {literal(pattern)}").collect()
    except PySparkException as error:
        return f"pattern refused: {error_class(error)}"
    return None


def error_class(error: PySparkException) -> str:
    return error.getCondition() or "invalid expression"
