"""Routing of random rows against a brute-force router, hot keys or not."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from sluice import schemas
from sluice.operators.skew import SkewGuard
from sluice.plans.feeds import ORDERS
from sluice.plans.routing import outcome_counts, rejected_rows, route, structured_rows
from sluice.sources.tables import ROW_ID, with_file_row_id

FIELDS = [*schemas.ORDERS_FEED.fieldNames(), schemas.INSERTED_AT]


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    found = []
    for _ in range(900):
        key = pick.choice(["hot", "hot", None, f"k{pick.randrange(80)}"])
        found.append(
            (
                key,
                pick.choice(["c1", "c2", "c3", None]),
                "p",
                dt.date(pick.choice([2019, 2020, 2024]), 5, pick.randrange(1, 4)),
                pick.choice([None, 0, 1, 2, 3]),
                pick.choice([None] * 9 + ["line"]),
                dt.datetime(2024, 1, pick.randrange(1, 5)),
            )
        )
    return found


@pytest.fixture(scope="module")
def raw(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("routing") / "raw")
    spark.createDataFrame(rows, schemas.raw_schema(schemas.ORDERS_FEED)).repartition(5).write.parquet(path)
    return with_file_row_id(spark.read.parquet(path))


def detail(row):
    messages = []
    if None in row[:4]:
        messages.append("Required field is null")
    if row[4] is None or row[4] <= 0:
        messages.append("Invalid quantity (zero or negative)")
    if row[3] is None or row[3] < dt.date(2020, 1, 1):
        messages.append("Invalid order date")
    return "; ".join(messages)


def brute_force(rows, prefer_valid, null_keys_are_duplicates):
    def nulls_first(value):
        return (value is not None, value if value is not None else 0)

    def rank(row):
        return (
            bool(prefer_valid and detail(row)),
            -row[6].timestamp(),
            [nulls_first(value) for value in row[1:5]],
        )

    found, groups = Counter(), defaultdict(list)
    for row in rows:
        if row[5] is not None:
            found[row, "corrupt", None] += 1
        elif row[0] is None and not null_keys_are_duplicates:
            found[row, "failed", detail(row)] += 1
        else:
            groups[row[0]].append(row)
    for group in groups.values():
        kept, *others = sorted(group, key=rank)
        for row in others:
            found[row, "duplicate", None] += 1
        found[kept, "failed" if detail(kept) else "clean", detail(kept) or None] += 1
    return found


@pytest.mark.parametrize("guard", [SkewGuard(min_rows=50), SkewGuard()])
@pytest.mark.parametrize("prefer_valid", [False, True])
@pytest.mark.parametrize("null_keys_are_duplicates", [False, True])
def test_routing_equals_brute_force(rows, raw, guard, prefer_valid, null_keys_are_duplicates):
    routed = route(
        ORDERS, raw, prefer_valid=prefer_valid, null_keys_are_duplicates=null_keys_are_duplicates, guard=guard
    )
    found = Counter(
        (tuple(r[name] for name in FIELDS), r.outcome, r.rejection_detail) for r in routed.drop(ROW_ID).collect()
    )
    assert found == brute_force(rows, prefer_valid, null_keys_are_duplicates)


def test_every_row_goes_somewhere_once(rows, raw):
    routed = route(ORDERS, raw)
    counts = {r.outcome: r.rows for r in outcome_counts(routed).collect()}
    assert sum(counts.values()) == len(rows)
    clean = structured_rows(ORDERS, routed)
    assert clean.count() == counts["clean"] == clean.select("order_id").distinct().count()
    assert rejected_rows(ORDERS, routed).count() == len(rows) - counts["clean"]
    flags = [rule.flag for rule in ORDERS.all_rules()]
    values = {value for row in routed.select(*flags).distinct().collect() for value in row}
    assert values == {"Y", "N"}


def test_feed_without_corrupt_column_has_no_corrupt_rows(raw):
    counts = {r.outcome for r in outcome_counts(route(ORDERS, raw.drop(schemas.CORRUPT))).collect()}
    assert counts == {"clean", "duplicate", "failed"}
