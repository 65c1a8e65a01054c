"""Access to nested fields that may be missing, and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot_path(schema: T.StructType, path: str) -> Column:
    """Column for a dotted path; null where any step is missing from the schema."""
    steps = path.split(".")
    current: T.DataType = schema
    column: Column | None = None
    for step in steps:
        if isinstance(current, T.StructType) and step in current.names:
            column = F.col(f"`{step}`") if column is None else column.getField(step)
            current = current[step].dataType
        elif isinstance(current, T.MapType) and column is not None:
            column = F.try_element_at(column, F.lit(step))
            current = current.valueType
        else:
            return F.lit(None)
    return column


def json_path(column: Column, path: str) -> Column:
    """Same access on raw JSON text."""
    return F.get_json_object(column, "$." + path)


def append_if(*pairs: tuple[Column, str]) -> Column:
    """Array of the texts whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in pairs]))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def fixed_text(value: Column, places: int = 2) -> Column:
    """A number below a million with so many decimals, by its exact binary value; ties go to the even digit.

    ``format_string`` rounds the shortest decimal form of a double instead, which differs from the
    double itself, and ties up. Here the number is split into a part of few binary digits and the
    rest, so that the distance to the tie is found without rounding.
    """
    scale = 10**places
    size = F.abs(value)
    high = F.floor(size * F.lit(2.0**26)) / F.lit(2.0**26)
    below = F.floor(size * F.lit(float(scale)))
    # Twice the distance from the tie between ``below`` and the number after it.
    past = high * F.lit(2.0 * scale) - (below * 2 + 1)
    rest = (size - high) * F.lit(2.0 * scale)
    up = (past > -rest) | ((past == -rest) & (below % 2 == 1))
    digits = (below + F.when(up, 1).otherwise(0)).cast("long")
    # Negative zero is written with its sign.
    sign = F.when((value < 0) | (value.cast("string") == "-0.0"), "-").otherwise("")
    whole = F.floor(digits / scale).cast("string")
    if not places:
        return F.when(value.isNotNull(), F.concat(sign, whole))
    return F.when(value.isNotNull(), F.concat(sign, whole, F.lit("."), F.lpad((digits % scale).cast("string"), places, "0")))


def percent_text(value: Column, places: int = 0) -> Column:
    # Ties go to the even digit; format_string alone would round them up.
    return F.format_string(f"%.{places}f%%", F.bround(value * F.lit(100.0), places))
