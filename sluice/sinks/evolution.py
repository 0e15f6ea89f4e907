"""How a stored schema takes up a frame: new columns are added, known ones keep their type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
# Digits before the point that an integral type may need.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def fits(given: T.DataType, known: T.DataType) -> bool:
    """Whether every value of ``given`` has an equal one in ``known``."""
    if given == known or isinstance(given, T.NullType):
        return True
    a, b = type(given), type(known)
    if a in _INTEGRAL:
        if b in _INTEGRAL:
            return _INTEGRAL.index(a) <= _INTEGRAL.index(b)
        if b is T.DecimalType:
            return known.precision - known.scale >= _DIGITS[a]
        return b is T.DoubleType and a is not T.LongType
    if a is T.DecimalType and b is T.DecimalType:
        return known.scale >= given.scale and known.precision - known.scale >= given.precision - given.scale
    if a is T.ArrayType and b is T.ArrayType:
        return fits(given.elementType, known.elementType)
    if a is T.StructType and b is T.StructType:
        return given.names == known.names and all(fits(x.dataType, y.dataType) for x, y in zip(given, known, strict=True))
    if a is T.MapType and b is T.MapType:
        return fits(given.keyType, known.keyType) and fits(given.valueType, known.valueType)
    return a is T.FloatType and b is T.DoubleType


def widened(known: T.StructType | None, given: T.StructType, what: str, complete: bool = True) -> T.StructType:
    """Known columns first, new ones after.

    A known column may not change to a type that does not fit it, nor, if rows
    must be ``complete``, be missing. Names are compared without case, as Spark does.
    """
    if known is None:
        return given
    by_name = {field.name.lower(): field for field in given.fields}
    missing = [field.name for field in known.fields if field.name.lower() not in by_name]
    if complete and missing:
        raise ValueError(f"{what} lack columns of the table: {', '.join(missing)}")
    changed = [
        f"{field.name} {by_name[field.name.lower()].dataType.simpleString()} instead of {field.dataType.simpleString()}"
        for field in known.fields
        if field.name.lower() in by_name and not fits(by_name[field.name.lower()].dataType, field.dataType)
    ]
    if changed:
        raise ValueError(f"{what} have columns of another type: {', '.join(changed)}")
    names = {field.name.lower() for field in known.fields}
    return T.StructType([*known.fields, *[field for field in given.fields if field.name.lower() not in names]])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the columns of a schema, in its order and types; absent ones are NULL."""
    given = {name.lower() for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{field.name}`") if field.name.lower() in given else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )
