"""Value transforms of the structured layer, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper price limits (exclusive) and the band below each; above all is the last.
PRICE_BANDS = [(50, "Budget"), (200, "Mid-Range"), (500, "Premium")]
TOP_PRICE_BAND = "Luxury"


def hash_pii(column: str, salt: str = "") -> Column:
    """SHA-256 of a personal value in lowercase hex; NULL stays NULL.

    Unsalted by default so that hashes join across tables; a salt is put in
    front of the value.
    """
    value = F.concat(F.lit(salt), F.col(column)) if salt else F.col(column)
    return F.sha2(value, 256)


def normalize_code(column: str) -> Column:
    return F.upper(F.trim(column))


def date_parts(column: str, prefix: str = "order") -> list[Column]:
    """Year, month and day of a date as three integer columns."""
    return [
        F.year(column).alias(f"{prefix}_year"),
        F.month(column).alias(f"{prefix}_month"),
        F.dayofmonth(column).alias(f"{prefix}_day"),
    ]


def clean_name(column: str) -> Column:
    """Trimmed text without anything but ASCII letters, digits and white space."""
    return F.regexp_replace(F.trim(column), r"[^a-zA-Z0-9\s]", "")


def price_band(column: str) -> Column:
    band = F
    for limit, name in PRICE_BANDS:
        band = band.when(F.col(column) < limit, F.lit(name))
    return band.otherwise(F.lit(TOP_PRICE_BAND))


def line_amount(quantity: str, price: str) -> Column:
    """Quantity times price, exact to nine decimals.

    NULL if the price is unknown, infinite or above 15 digits, or the quantity
    above 13: such a line has no amount, and reports count it. Decimal, so that
    sums do not depend on the order in which tasks finish.
    """
    return F.col(quantity).try_cast("decimal(13,0)") * F.col(price).try_cast("decimal(24,9)")


def map_value(column: str, mapping: Mapping[str, str]) -> Column:
    """Look a value up in a small fixed mapping; NULL where it has no entry."""
    entries = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    return F.try_element_at(entries, F.col(column))
