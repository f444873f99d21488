"""Column lookup, type families, and the SQL that prepares a cell for a metric.

Formulas are written as SQL text: a profile has hundreds of them, and one parsed text is far
quicker to hand to Spark than the calls that would build it piece by piece.
"""

from __future__ import annotations

from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def find_field(schema: T.StructType, name: str) -> T.StructField | None:
    """The field called ``name``; another spelling of its case will do if it is the only one."""
    for field in schema.fields:
        if field.name == name:
            return field
    alike = [f for f in schema.fields if f.name.lower() == name.lower()]
    return alike[0] if len(alike) == 1 else None


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_atomic(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.NullType))


def is_groupable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return is_groupable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_groupable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))


def literal(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_number(cell: str, dtype: T.DataType) -> str:
    """A double; text that is no number becomes null instead of an error."""
    cast = "try_cast" if isinstance(dtype, T.StringType) else "CAST"
    return f"{cast}({cell} AS DOUBLE)"


def group_type(dtype: T.DataType) -> str:
    """The type under which values are compared when they are counted.

    Widening integers to bigint and float to double maps distinct values to distinct values. A text
    with a collation keeps it: what is equal there is one value.
    """
    if isinstance(dtype, INTEGRAL):
        return "bigint"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dtype, (T.CharType, T.VarcharType, T.NullType)):
        return "string"
    return dtype.simpleString()


def group_value(cell: str, dtype: T.DataType) -> str:
    """The value that stands for a cell in a frequency table."""
    target = group_type(dtype)
    return cell if dtype.simpleString() == target else f"CAST({cell} AS {target})"


def sketch_value(cell: str, dtype: T.DataType) -> str:
    """A value a distinct-count sketch accepts, equal exactly where the cells are equal."""
    target = group_type(dtype)
    if target == "bigint":
        return f"CAST({cell} AS BIGINT)"
    if target == "double":
        # Adding zero turns -0.0 into 0.0.
        return f"CAST(CAST({cell} AS DOUBLE) + 0.0D AS STRING)"
    return cell if target == "binary" or isinstance(dtype, T.StringType) else f"CAST({cell} AS STRING)"
