"""Counts from footers and from bitmaps, against plain aggregation."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.distinct import DistinctCounts, count_bitmaps, key_bitmaps
from sluice.sinks.snapshot import SnapshotTable
from sluice.sources import footers


def plan_of(frame, mode="formatted"):
    return frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_footers_give_counts_and_bounds(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1_000).select("id", (F.col("id") % 3).alias("part"), (F.col("id") / 4).alias("x"))
    rows.repartition(4).write.partitionBy("part").parquet(path)
    frame = footers._totals(spark, [path], ["id", "x"], ["part"], None, True)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(x), MAX(x)]" in plan_of(frame)
    wanted = rows.groupBy("part").agg(F.count("*"), F.min("id"), F.max("id"), F.min("x"), F.max("x")).collect()
    assert sorted(map(tuple, footers.footer_totals(spark, [path], ["id", "x"], ["part"]))) == sorted(map(tuple, wanted))
    two = [f"{path}/part=0", f"{path}/part=2"]
    assert footers.footer_count(spark, two) == rows.filter("part <> 1").count()
    assert [r["part"] for r in sorted(footers.footer_totals(spark, two, by=["part"], base_path=path))] == [0, 2]
    assert footers.footer_count(spark, []) == 0
    assert spark.conf.get(footers.PUSHDOWN) == "false"


def test_bounds_that_no_footer_has_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select("id", F.lit(None).cast("int").alias("n"), F.concat(F.lit("s"), "id").alias("s"))
    rows.write.parquet(path)
    assert tuple(footers.footer_totals(spark, [path], ["n", "s"])[0]) == (10, None, None, "s0", "s9")
    rows.filter("false").write.parquet(str(tmp_path / "empty"))
    assert tuple(footers.footer_totals(spark, [str(tmp_path / "empty")], ["id"])[0]) == (0, None, None)


def test_a_version_without_a_count_is_counted_from_footers(spark, tmp_path):
    from dataclasses import replace

    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=4)
    first = target.upsert(spark.range(50).withColumnRenamed("id", "k"))
    assert target._rows(replace(first, rows=None)) == 50
    assert target._rows(replace(first, rows=None, segments=[])) == 0


@pytest.mark.parametrize("clustered", [False, True])
def test_bitmaps_equal_count_distinct(spark, clustered):
    rng = random.Random(4)
    keys = [-(2**63), -32_769, -32_768, -32_767, -1, 0, 1, 32_768, 32_769, 2**40, None]
    rows = [(rng.choice("abc"), rng.choice(keys)) for _ in range(300)] + [("hot", rng.randrange(100_000)) for _ in range(3_000)]
    frame = spark.createDataFrame([*rows, ("none", None)], "g string, k long")
    found = key_bitmaps(frame, "k", ["g"], clustered)
    for groups in (["g"], []):
        wanted = frame.groupBy(*groups).agg(F.count_distinct("k").alias("distinct"))
        assert sorted(map(tuple, count_bitmaps(found, groups).collect())) == sorted(map(tuple, wanted.collect()))
    assert count_bitmaps(key_bitmaps(frame.filter("false"), "k"), name="n").first()["n"] == 0
    with pytest.raises(TypeError):
        key_bitmaps(frame, "g")


def test_clustered_keys_are_not_shuffled(spark):
    frame = spark.range(100_000).withColumnRenamed("id", "k")
    plan = plan_of(key_bitmaps(frame, "k", clustered=True), "simple")
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan.split("Exchange")[1]


def test_kept_bitmaps_count_without_the_rows(spark, tmp_path):
    kept = DistinctCounts(spark, str(tmp_path / "kept"), "k", ["g"])
    parts = [spark.range(a, b).select((F.col("id") % 5).alias("g"), (F.col("id") % 700).alias("k")) for a, b in ((0, 500), (400, 900), (900, 950))]
    for version, rows in enumerate(parts):
        kept.add(rows, version)
    kept.add(parts[1], 1)  # a repeated batch
    everything = parts[0].union(parts[1]).union(parts[2])
    assert kept.count().first()[0] == 700
    wanted = everything.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()
    assert sorted(map(tuple, kept.count(["g"], "n").collect())) == sorted(map(tuple, wanted))
    assert "ReadSchema: struct<g:bigint,_key_range:bigint,_keys:binary>" in plan_of(kept.count(["g"]))
