"""Rules on edge values: NULL, absent columns, bounds, and reasons."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions import flags, transforms
from sluice.operators import quality
from sluice.operators.quality import Rule


def column_of(frame, name):
    return [row[name] for row in frame.collect()]


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, "ann@x.org", 5, dt.date(2020, 1, 1), "abc"),
        (2, "no at sign", 0, dt.date(2019, 12, 31), ""),
        (3, None, None, None, None),
        (4, " ann@x.org", -1, dt.date(2999, 1, 1), "abcdef"),
        (5, "a@b.c", 1, dt.date(2020, 6, 1), "ab"),
    ]
    return spark.createDataFrame(rows, "id int, email string, n int, d date, s string").coalesce(1)


def test_required(people):
    assert column_of(quality.check_null_values(people, ["email", "s"]), "has_null_required") == ["N", "N", "Y", "N", "N"]
    assert column_of(quality.check_null_values(people, ["absent"]), "has_null_required") == ["N"] * 5
    assert column_of(quality.check_null_values(people, ["absent", "n"]), "has_null_required") == ["N", "N", "Y", "N", "N"]
    with pytest.raises(ValueError, match="absent"):
        quality.check_null_values(people, ["absent"], strict=True)


def test_email(people):
    assert column_of(quality.check_email_format(people, "email"), "is_valid_email") == ["Y", "N", "N", "N", "N"]


def test_positive(people):
    checked = quality.check_positive_values(people, ["n", "absent"])
    assert column_of(checked, "is_valid_n") == ["Y", "N", "N", "N", "Y"]
    assert "is_valid_absent" not in checked.columns


def test_date_range(people):
    bounded = quality.check_date_range(people, "d", "2020-01-01", "2020-06-01")
    assert column_of(bounded, "is_valid_date") == ["Y", "N", "N", "N", "Y"]
    assert column_of(quality.check_date_range(people, "d"), "is_valid_date") == ["Y", "Y", "N", "Y", "Y"]
    with pytest.raises(ValueError):
        quality.check_date_range(people, "d", "2020-13-01")


def test_length(people):
    checked = quality.check_string_length(people, {"s": (2, 3), "email": (None, None), "absent": (1, 2)})
    assert column_of(checked, "is_valid_length_s") == ["Y", "N", "N", "N", "Y"]
    assert checked.columns == [*people.columns, "is_valid_length_s"]


def test_domain(people):
    assert column_of(quality.check_domain(people, "s", ["abc"], "ok"), "ok") == ["Y", "N", "N", "N", "N"]


def test_corrupt_split(people):
    marked = people.withColumn("_corrupt_records", F.when(F.col("id") > 3, F.lit("line")))
    valid, corrupt = quality.check_corrupt_records(marked)
    assert (column_of(valid, "id"), column_of(corrupt, "id")) == ([1, 2, 3], [4, 5])
    valid, corrupt = quality.check_corrupt_records(people)
    assert valid.count() == 5 and corrupt.count() == 0 and corrupt.columns == people.columns


def test_flag_and_its_negation_cover_all_rows(people):
    tagged = quality.check_positive_values(people, ["n"])
    bad = F.col("is_valid_n") == "N"
    assert tagged.filter(bad).count() + tagged.filter(~bad).count() == 5


@pytest.mark.parametrize("max_broadcast_rows", [None, 0])
def test_reference_keeps_every_row_once(spark, people, max_broadcast_rows):
    lookup = spark.createDataFrame([("abc",), ("abc",), ("ab",), (None,)], "code string")
    checked = quality.check_referential_integrity(people, lookup, "s", "code", max_broadcast_rows=max_broadcast_rows)
    assert {r.id: r.is_valid_ref for r in checked.collect()} == {1: "Y", 2: "N", 3: "N", 4: "N", 5: "Y"}
    assert checked.columns == [*people.columns, "is_valid_ref"]
    assert checked.count() == 5


def test_reasons(people):
    rules = [
        Rule("has_null_required", flags.any_null(["email", "n"]), bad_value="Y", message="missing"),
        Rule("is_valid_n", flags.positive("n"), message="not positive"),
    ]
    tagged = people.withColumns({rule.flag: rule.expression for rule in rules})
    messages = {rule.flag: rule.message for rule in rules} | {"absent": "never"}
    reasons = quality.add_rejection_reasons(tagged, messages, {"has_null_required": "Y"})
    assert column_of(reasons, "rejection_reason") == [None, "not positive", "missing; not positive", "not positive", None]
    assert column_of(quality.add_rejection_reasons(people, {"absent": "never"}), "rejection_reason") == [None] * 5
    counts = quality.count_failures(tagged, rules).first()
    assert tuple(counts) == (5, 1, 3)


def test_transforms(spark):
    frame = spark.createDataFrame([("  De-sk é 1 ", " us ", 49.99), ("", None, 500.0)], "name string, code string, price double")
    rows = frame.select(
        transforms.clean_name("name").alias("name"),
        transforms.normalize_code("code").alias("code"),
        transforms.price_band("price").alias("band"),
        transforms.hash_pii("code").alias("hash"),
        transforms.map_value("code", {" us ": "here"}).alias("region"),
    ).collect()
    assert [tuple(r)[:3] for r in rows] == [("Desk  1", "US", "Budget"), ("", None, "Luxury")]
    assert rows[1].hash is None and [r.region for r in rows] == ["here", None]
