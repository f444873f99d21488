"""The class a value would have if its column were typed by looking at the text."""

from __future__ import annotations

from pyspark.sql import types as T

from tallygauge.functions.columns import INTEGRAL, literal

# The five classes in output order and the patterns that decide them.
CLASSES = ("Unknown", "Fractional", "Integral", "Boolean", "String")
INTEGRAL_PATTERN = r"^[-+]?\d+\z"
FRACTIONAL_PATTERN = r"^[-+]?(\d+\.\d*|\.\d+)\z"
BOOLEAN_PATTERN = r"^(true|false)\z"


def value_class(cell: str, dtype: T.DataType) -> str:
    """SQL for the position in ``CLASSES`` of each value's class.

    Types whose text form always falls into one class skip the patterns.
    """
    code = {name: i for i, name in enumerate(CLASSES)}
    if isinstance(dtype, INTEGRAL):
        known = code["Integral"]
    elif isinstance(dtype, T.BooleanType):
        known = code["Boolean"]
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        known = code["String"]
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        # The text of a double is plain digits within this range, and has an exponent outside.
        plain = f"{cell} = 0 OR (abs({cell}) >= 1e-3D AND abs({cell}) < 1e7D)"
        known = f"CASE WHEN {plain} THEN {code['Fractional']} ELSE {code['String']} END"
    else:
        text = f"CAST({cell} AS STRING)"
        known = (
            f"CASE WHEN {text} RLIKE {literal(INTEGRAL_PATTERN)} THEN {code['Integral']} "
            f"WHEN {text} RLIKE {literal(FRACTIONAL_PATTERN)} THEN {code['Fractional']} "
            f"WHEN {text} RLIKE {literal(BOOLEAN_PATTERN)} THEN {code['Boolean']} "
            f"ELSE {code['String']} END"
        )
    return f"CASE WHEN {cell} IS NULL THEN {code['Unknown']} ELSE {known} END"
