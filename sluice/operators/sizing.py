"""Size check that stands before every broadcast."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType, VariantType

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16


def _width(field: StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long")
    return F.lit(_FIXED_WIDTH).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is within both bounds, by measuring it; nested values count as JSON.

    One aggregation over the frame's own columns; nothing but two numbers moves.
    """
    widths = [_width(field) for field in df.schema.fields]
    rows, size = df.agg(F.count("*"), F.sum(reduce(add, widths))).first()
    return rows <= max_rows and (size or 0) <= max_bytes
