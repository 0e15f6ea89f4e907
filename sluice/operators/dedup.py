"""Keep-first deduplication that also says which rows are the duplicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from sluice.operators.skew import DEFAULT_GUARD, SkewGuard, is_hot
from sluice.sources.tables import ROW_ID, with_row_id


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, MapType)


def total_order(df: DataFrame, keys: list[str], first: list[Column] | None = None) -> list[Column]:
    """Order by ``first``, then by all columns that are no key.

    Rows equal in all of these are equal altogether, so it does not matter
    which one is kept: the outcome depends on neither row order nor partitioning.
    Maps have no order and are compared as JSON.
    """
    names = [name for name in df.columns if name not in keys and name != ROW_ID]
    columns = [
        F.to_json(F.struct(F.col(f"`{name}`"))) if _holds_map(df.schema[name].dataType) else F.col(f"`{name}`")
        for name in names
    ]
    return [*(first or []), *[column.asc_nulls_first() for column in columns]]


def keep_first(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """First row of each key by ``order``, then by all other columns; NULL keys form one group.

    A bound on ``row_number`` lets Spark cut every key to one row per map task
    before the shuffle, so a hot key does no harm here.
    """
    order = total_order(df, keys, order) or [F.col(keys[0])]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def tag_first(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    *,
    exempt: Column | None = None,
    tag: str = "is_first",
    guard: SkewGuard = DEFAULT_GUARD,
    hot: Mapping[int, float] | None = None,
    total: bool = False,
) -> DataFrame:
    """Add a boolean: is the row the first of its key? Exempt rows always are.

    Rows are compared by ``order`` and then by all other columns, so that the
    answer never depends on which keys are hot; ``total`` says that ``order``
    leaves no ties but between equal rows already. ``hot`` hands in hot keys
    that were counted on a cheaper frame.

    Ordinary keys are ranked in one window, where exempt rows are spread by
    their identity. The rows of a hot key would all meet in one task there.
    They stay where they are instead: the first one is found with the map-side
    cut of :func:`keep_first`, and all are compared with its identity.
    """
    columns = df.columns
    order = (order if total else total_order(df, keys, order)) or [F.col(keys[0])]
    subject = F.lit(True) if exempt is None else ~exempt
    if hot is None:
        hot = guard.hot_keys(df.filter(subject), keys)
    if hot or exempt is not None:
        df = with_row_id(df)

    apart = subject & is_hot(keys, hot)
    cold = df.filter(~apart) if hot else df
    if exempt is None:
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    else:
        cold = cold.withColumn("_spread", F.when(exempt, F.xxhash64(ROW_ID)))
        first = exempt | (F.row_number().over(Window.partitionBy(*keys, "_spread").orderBy(*order)) == 1)
    tagged = cold.select(*columns, first.alias(tag))
    if not hot:
        return tagged

    hot_rows = df.filter(apart)
    winners = keep_first(hot_rows, keys, [*order, F.col(ROW_ID)]).select(ROW_ID, F.lit(True).alias("_won"))
    # One row for each key behind at most guard.max_keys hot hashes.
    judged = hot_rows.join(F.broadcast(winners), ROW_ID, "left")
    return tagged.unionByName(judged.select(*columns, F.coalesce("_won", F.lit(False)).alias(tag)))


def split_duplicates(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    guard: SkewGuard = DEFAULT_GUARD,
) -> tuple[DataFrame, DataFrame]:
    """Kept rows and duplicates; together they are the input.

    Both are read off one tag. Write the tagged rows once if both are stored.
    """
    order = total_order(df, keys, order)
    if ROW_ID in df.columns:  # so that equal rows keep their identities apart as well
        order.append(F.col(ROW_ID))
    tagged = tag_first(df, keys, order, tag="_is_first", guard=guard, total=True)
    return tagged.filter("_is_first").drop("_is_first"), tagged.filter("not _is_first").drop("_is_first")
