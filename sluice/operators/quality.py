"""Quality rules applied to frames: splits, flags, reasons and counts.

A rule on a column the frame lacks is skipped, or refused with ``strict``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import flags, transforms
from sluice.operators.skew import SkewGuard, lookup_join
from sluice.schemas import CORRUPT


@dataclass(frozen=True)
class Rule:
    """A flag, how it is computed, which of its values is bad, and what to say then.

    Only a ``hard`` rule rejects rows. A rule with ``lookup`` takes its flag
    from a join instead of an expression.
    """

    flag: str
    expression: Column | None = None
    bad_value: str = "N"
    message: str | None = None
    hard: bool = True
    lookup: str | None = None
    column: str | None = None

    @property
    def failed(self) -> Column:
        return F.col(self.flag) == self.bad_value


def _present(df: DataFrame, columns: list[str], strict: bool) -> list[str]:
    missing = [name for name in columns if name not in df.columns]
    if strict and missing:
        raise ValueError(f"columns to check are missing: {', '.join(missing)}")
    return [name for name in columns if name not in missing]


def check_corrupt_records(df: DataFrame, corrupt_column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Valid and corrupt rows; without the column every row is valid."""
    if corrupt_column not in df.columns:
        return df, df.filter(F.lit(False))
    return df.filter(F.col(corrupt_column).isNull()), df.filter(F.col(corrupt_column).isNotNull())


def check_null_values(
    df: DataFrame, required_columns: list[str], tag_column: str = "has_null_required", strict: bool = False
) -> DataFrame:
    """Tag ``'Y'``, meaning bad, where a required column is NULL; empty text is a value."""
    return df.withColumn(tag_column, flags.any_null(_present(df, required_columns, strict)))


def check_email_format(df: DataFrame, email_column: str, valid_flag_column: str = "is_valid_email") -> DataFrame:
    return df.withColumn(valid_flag_column, flags.email_format(email_column))


def check_positive_values(
    df: DataFrame, numeric_columns: list[str], flag_prefix: str = "is_valid_", strict: bool = False
) -> DataFrame:
    columns = _present(df, numeric_columns, strict)
    return df.withColumns({f"{flag_prefix}{name}": flags.positive(name) for name in columns})


def check_date_range(
    df: DataFrame,
    date_column: str,
    min_date: str | dt.date | None = None,
    max_date: str | dt.date | None = None,
    flag_column: str = "is_valid_date",
) -> DataFrame:
    return df.withColumn(flag_column, flags.date_between(date_column, min_date, max_date))


def check_string_length(
    df: DataFrame,
    string_columns: Mapping[str, tuple[int | None, int | None]],
    flag_prefix: str = "is_valid_length_",
    strict: bool = False,
) -> DataFrame:
    """Flag texts by inclusive length bounds; a column with no bound gets no flag."""
    bounded = {
        f"{flag_prefix}{name}": flags.length_between(name, *string_columns[name])
        for name in _present(df, list(string_columns), strict)
    }
    return df.withColumns({flag: value for flag, value in bounded.items() if value is not None})


def check_domain(df: DataFrame, column: str, values: list[str], flag_column: str) -> DataFrame:
    return df.withColumn(flag_column, flags.in_domain(column, values))


def check_referential_integrity(
    df: DataFrame,
    lookup_df: DataFrame,
    check_column: str,
    lookup_column: str,
    flag_column: str = "is_valid_ref",
    *,
    normalize: bool = False,
    guard: SkewGuard | None = None,
    max_broadcast_rows: int | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """Flag values found in the lookup; rows are neither lost nor multiplied.

    ``normalize`` compares trimmed upper-case values instead of exact ones. A
    NULL value is in no lookup. ``guard`` and ``prefilter`` are those of
    :func:`lookup_join`.
    """
    as_compared = transforms.normalize_code if normalize else F.col
    members = lookup_df.select(as_compared(lookup_column).alias("_member")).dropna().dropDuplicates()
    probed = df.select("*", as_compared(check_column).alias("_member"))
    joined = lookup_join(
        probed,
        members.select("_member", F.lit(True).alias("_is_member")),
        "_member",
        guard=guard,
        max_broadcast_rows=max_broadcast_rows,
        prefilter=prefilter,
    )
    return joined.withColumn(flag_column, flags.yes_no(F.col("_is_member"))).select(*df.columns, flag_column)


def add_rejection_reasons(
    df: DataFrame,
    messages: Mapping[str, str],
    bad_values: Mapping[str, str] | None = None,
    column: str = "rejection_reason",
) -> DataFrame:
    """Join the messages of all failed flags; ``bad_values`` names flags that fail on another value than ``'N'``."""
    bad_values = bad_values or {}
    failures = [
        (F.col(flag) == bad_values.get(flag, "N"), message)
        for flag, message in messages.items()
        if flag in df.columns
    ]
    return df.withColumn(column, flags.joined_messages(failures))


def count_failures(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: all rows, and the failures of each rule, in a single pass."""
    return df.agg(
        F.count("*").alias("rows"), *[F.count_if(rule.failed).alias(f"failed_{rule.flag}") for rule in rules]
    )
