"""Quality flags as column expressions.

Every flag is ``'Y'`` or ``'N'`` and never NULL, so a rejection predicate built
from flags and its negation split a frame without losing rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a well-formed email address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def yes_no(condition: Column) -> Column:
    """``'Y'`` where the condition holds, ``'N'`` where it is false or NULL."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def any_null(columns: Iterable[str]) -> Column:
    """``'Y'`` (bad) where at least one of the columns is NULL."""
    return yes_no(reduce(or_, [F.col(name).isNull() for name in columns], F.lit(False)))


def email_format(column: str) -> Column:
    return yes_no(F.col(column).rlike(EMAIL_PATTERN))


def positive(column: str) -> Column:
    return yes_no(F.col(column) > 0)


def _as_bound(bound: str | dt.date) -> Column:
    """A date, or a time of day without a zone, as a literal."""
    if isinstance(bound, str):
        bound = dt.datetime.fromisoformat(bound) if len(bound.strip()) > 10 else dt.date.fromisoformat(bound)
    if isinstance(bound, dt.datetime):
        return F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(bound)


def date_between(
    column: str, min_date: str | dt.date | None = None, max_date: str | dt.date | None = None
) -> Column:
    """``'Y'`` for a date within the bounds, both inclusive and both optional.

    A bound may have a time of day; a date is then its first moment. Bounds
    become literals here, so a malformed one fails when the plan is
    built and a good one can be pushed to the scan.
    """
    conditions = [F.col(column).isNotNull()]
    if min_date:
        conditions.append(F.col(column) >= _as_bound(min_date))
    if max_date:
        conditions.append(F.col(column) <= _as_bound(max_date))
    return yes_no(reduce(and_, conditions))


def length_between(column: str, min_length: int | None, max_length: int | None) -> Column | None:
    """``'Y'`` for a text of fitting length; no flag at all without a bound."""
    conditions = []
    if min_length is not None:
        conditions.append(F.length(column) >= min_length)
    if max_length is not None:
        conditions.append(F.length(column) <= max_length)
    return yes_no(reduce(and_, conditions)) if conditions else None


def in_domain(column: str, values: Iterable[str]) -> Column:
    return yes_no(F.col(column).isin(list(values)))


def joined_messages(failures: Iterable[tuple[Column, str]]) -> Column:
    """Messages of the conditions that hold, joined with ``"; "``; NULL if none does."""
    messages = [F.when(condition, F.lit(message)) for condition, message in failures]
    if not messages:
        return F.lit(None).cast("string")
    found = F.array_compact(F.array(*messages))
    return F.when(F.size(found) > 0, F.array_join(found, "; "))
