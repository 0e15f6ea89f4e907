"""Route raw rows of a feed: clean, corrupt, duplicate or failed, each exactly once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import flags
from sluice.functions.transforms import hash_pii
from sluice.operators.dedup import tag_first, total_order
from sluice.operators.quality import check_referential_integrity
from sluice.operators.skew import DEFAULT_GUARD, SkewGuard
from sluice.plans.feeds import Feed
from sluice.schemas import CORRUPT, INSERTED_AT, STRUCTURED_AT

CLEAN, CORRUPTED, DUPLICATE, FAILED = "clean", "corrupt", "duplicate", "failed"

# The reason stored with a rejected row of each kind.
REASONS = {
    CORRUPTED: "Corrupt record - parsing failed",
    DUPLICATE: "Duplicate record",
    FAILED: "Data quality check failed",
}


def route(
    feed: Feed,
    raw: DataFrame,
    lookups: Mapping[str, DataFrame] | None = None,
    *,
    prefer_valid: bool = False,
    null_keys_are_duplicates: bool = False,
    normalize: bool = False,
    guard: SkewGuard = DEFAULT_GUARD,
) -> DataFrame:
    """Raw columns, flags, ``outcome``, ``rejection_reason`` and ``rejection_detail``.

    Corrupt rows leave first; the others are flagged, then one row of each key
    is kept, and only then do failed rules reject. The newest row is kept, or
    with ``prefer_valid`` the newest one that passes the rules.

    A row with a NULL key fails its required-field rule. Unless
    ``null_keys_are_duplicates``, such rows are not compared with each other,
    so each of them is reported as failed. ``normalize`` checks codes against
    the lookups trimmed and in upper case.

    ``raw`` should carry a row identity (:func:`sluice.sources.tables.with_file_row_id`);
    a frame without one is written out once to get it.
    """
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    columns = raw.columns
    rules = feed.all_rules()
    tagged = raw.withColumns({rule.flag: rule.expression for rule in rules if rule.expression is not None})
    failed = reduce(or_, [rule.failed for rule in rules if rule.hard])

    corrupt = F.col(CORRUPT).isNotNull()
    exempt = corrupt if null_keys_are_duplicates else corrupt | F.col(feed.key).isNull()
    newest = [F.col(INSERTED_AT).desc_nulls_last()] if INSERTED_AT in columns else []
    if prefer_valid:
        newest.insert(0, failed.asc())
    # Hot keys are counted on the scan itself, and lookups join raw rows, before anything was shuffled.
    hot = guard.hot_keys(raw.filter(~exempt), [feed.key])
    for rule in rules:
        if rule.lookup is not None:
            lookup = (lookups or {})[rule.lookup]
            tagged = check_referential_integrity(
                tagged, lookup, rule.column, rule.lookup, rule.flag, normalize=normalize
            )
    order = total_order(raw, [feed.key, INSERTED_AT, CORRUPT], newest)
    tagged = tag_first(tagged, [feed.key], order, exempt=exempt, guard=guard, hot=hot, total=True)

    outcome = (
        F.when(corrupt, F.lit(CORRUPTED))
        .when(~F.col("is_first"), F.lit(DUPLICATE))
        .when(failed, F.lit(FAILED))
        .otherwise(F.lit(CLEAN))
    )
    reason = reduce(lambda chain, item: chain.when(F.col("outcome") == item[0], F.lit(item[1])), REASONS.items(), F)
    messages = flags.joined_messages([(rule.failed, rule.message) for rule in rules if rule.hard])
    return (
        tagged.withColumn("outcome", outcome)
        .withColumns(
            {"rejection_reason": reason, "rejection_detail": F.when(F.col("outcome") == FAILED, messages)}
        )
        .select(*columns, *[rule.flag for rule in rules], "outcome", "rejection_reason", "rejection_detail")
    )


def structured_rows(feed: Feed, routed: DataFrame) -> DataFrame:
    """Clean rows in the shape of the structured table."""
    stamp = F.current_timestamp().alias(STRUCTURED_AT)
    return routed.filter(F.col("outcome") == CLEAN).select(*feed.structured(), stamp)


def rejected_rows(feed: Feed, routed: DataFrame, hash_columns: list[str] | None = None, salt: str = "") -> DataFrame:
    """Rejected rows in the shape of the quarantine table.

    ``hash_columns`` hides personal values; the raw text of a corrupt line,
    which may contain them, is then hashed too.
    """
    hidden = [*(hash_columns or []), *([CORRUPT] if hash_columns else [])]
    source = [hash_pii(c, salt).alias(c) if c in hidden else F.col(c) for c in [*feed.columns, CORRUPT]]
    return routed.filter(F.col("outcome") != CLEAN).select(
        *source, "rejection_reason", "rejection_detail", F.current_timestamp().alias("rejected_at")
    )


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("outcome").agg(F.count("*").alias("rows"))
