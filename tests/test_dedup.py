"""Deduplication and lookup joins: hot or not, the rows are the same."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.operators import dedup
from sluice.operators.skew import SkewGuard, lookup_join
from sluice.sources.tables import ROW_ID, with_file_row_id

HOT = SkewGuard(min_rows=20, max_keys=50)
COLD = SkewGuard(min_rows=10**9)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows under one key, a third exact copies, NULL keys, and the rest spread."""
    pick = random.Random(5)
    found = [("hot", pick.randrange(40), "v") for _ in range(300)]
    found += [("copies", 7, "same")] * 300
    found += [(None, pick.randrange(3), None) for _ in range(60)]
    found += [(f"k{pick.randrange(120)}", pick.randrange(5), pick.choice(["a", None])) for _ in range(240)]
    pick.shuffle(found)
    return found


@pytest.fixture(scope="module")
def frame(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dedup") / "rows")
    spark.createDataFrame(rows, "k string, n int, s string").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def expected_kept(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return Counter(min(group, key=lambda r: (r[1], r[2] is not None, r[2] or "")) for group in groups.values())


@pytest.mark.parametrize("guard", [HOT, COLD])
@pytest.mark.parametrize("identified", [True, False])
def test_split_equals_brute_force(frame, rows, guard, identified):
    source = with_file_row_id(frame) if identified else frame
    kept, duplicates = dedup.split_duplicates(source, ["k"], guard=guard)
    kept_rows = Counter(map(tuple, kept.select("k", "n", "s").collect()))
    duplicate_rows = Counter(map(tuple, duplicates.select("k", "n", "s").collect()))
    assert kept_rows == expected_kept(rows)
    assert kept_rows + duplicate_rows == Counter(rows)
    assert duplicates.columns == source.columns


@pytest.mark.parametrize("guard", [HOT, COLD])
@pytest.mark.parametrize("files", [1, 7])
@pytest.mark.parametrize("identified", [True, False])
def test_an_order_with_ties_loses_and_repeats_nothing(spark, frame, rows, tmp_path, guard, files, identified):
    frame.orderBy("n").repartition(files, "s").write.parquet(str(tmp_path / "rows"))
    source = spark.read.parquet(str(tmp_path / "rows"))
    source = with_file_row_id(source) if identified else source
    kept, duplicates = dedup.split_duplicates(source, ["k"], [F.lit(1).asc(), F.desc("n")], guard)
    kept_rows = Counter(map(tuple, kept.select("k", "n", "s").collect()))
    assert sorted(map(str, (r[0] for r in kept_rows))) == sorted({str(r[0]) for r in rows}) and set(kept_rows.values()) == {1}
    assert kept_rows + Counter(map(tuple, duplicates.select("k", "n", "s").collect())) == Counter(rows)
    if identified:
        ids = lambda df: {tuple(r[0]) for r in df.select(ROW_ID).collect()}
        assert not ids(kept) & ids(duplicates) and len(ids(kept) | ids(duplicates)) == len(rows)


def test_map_columns_are_compared(spark):
    rows = spark.sql("SELECT id % 3 AS k, map('a', id) AS m, array(struct(map(1, 2) AS x)) AS a FROM range(12)")
    kept, duplicates = dedup.split_duplicates(rows, ["k"])
    assert sorted(r.k for r in kept.collect()) == [0, 1, 2] and duplicates.count() == 9


@pytest.mark.parametrize("guard", [HOT, COLD])
def test_exempt_rows_are_first_and_do_not_compete(frame, guard):
    exempt = F.col("k").isNull() | (F.col("n") == 0)
    tagged = dedup.tag_first(with_file_row_id(frame), ["k"], exempt=exempt, guard=guard)
    assert tagged.filter(exempt & ~F.col("is_first")).count() == 0
    subject = tagged.filter(~exempt)
    assert subject.filter("is_first").count() == subject.select("k").distinct().count()
    assert tagged.count() == frame.count()


def test_composite_keys(frame, rows):
    kept, duplicates = dedup.split_duplicates(frame, ["k", "s"])
    assert kept.count() == len({(r[0], r[2]) for r in rows})
    assert kept.count() + duplicates.count() == len(rows)


def test_hot_keys_are_counted_exactly(frame):
    names = frame.select("k", F.xxhash64("k").alias("h")).distinct()
    hot = HOT.hot_keys(frame, ["k"])
    assert {r.k for r in names.filter(F.col("h").isin(list(hot))).collect()} == {"hot", "copies", None}
    assert sorted(hot.values()) == [60 / 900, 1 / 3, 1 / 3]
    assert COLD.hot_keys(frame, ["k"]) == {}
    assert len(SkewGuard(min_rows=1, max_keys=4).hot_keys(frame, ["k"])) <= 4


@pytest.mark.parametrize("spread_by", [None, ["n", "s"]])
def test_salted_join_equals_plain_join(spark, frame, spread_by):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, v int")
    plain = Counter(map(tuple, frame.join(lookup, "k", "left").collect()))
    salted = lookup_join(frame, lookup, "k", spread_by, HOT, max_broadcast_rows=0)
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    assert Counter(map(tuple, salted.collect())) == plain
    assert Counter(map(tuple, lookup_join(frame, lookup, "k").collect())) == plain


def test_salts_spread_a_hot_key_over_the_partitions(spark, frame):
    lookup = spark.createDataFrame([("copies", 1)], "k string, v int")
    salted = lookup_join(with_file_row_id(frame), lookup, "k", [ROW_ID], HOT, max_broadcast_rows=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = salted.filter("k = 'copies'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 300
