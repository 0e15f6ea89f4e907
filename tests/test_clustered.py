"""What a bounded scan reads of a clustered table."""

from pyspark.sql import functions as F

from sluice.sinks.clustered import write_clustered
from sluice.sources.tables import read_path, rows_after


def scanned_rows(frame):
    """Rows that came out of the scan, before the filter in Spark."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_narrow_bound_reads_few_rows(spark, tmp_path):
    shuffled = spark.range(40_000).select(((F.col("id") * 7_919) % 40_000).alias("stamp"), F.lit("x").alias("v"))
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    shuffled.repartition(8).write.parquet(plain)
    write_clustered(shuffled, laid, ["stamp"], files=8)
    found = {path: rows_after(read_path(spark, path), "stamp", 39_899) for path in (plain, laid)}
    assert sorted(r.stamp for r in found[laid].collect()) == list(range(39_900, 40_000)) == sorted(r.stamp for r in found[plain].collect())
    assert scanned_rows(found[plain]) == 40_000
    assert 100 <= scanned_rows(found[laid]) <= 40_000 // 8 * 2


def test_hot_and_missing_values_and_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id"))).alias("stamp"))
    write_clustered(rows, path, ["stamp"])
    write_clustered(rows.filter("stamp > 2000"), path, ["stamp"], row_group_bytes=1 << 20)
    kept = read_path(spark, path)
    assert kept.count() == 3_000 + rows.filter("stamp > 2000").count()
    assert rows_after(kept, "stamp", 2_000).count() == 2 * rows.filter("stamp > 2000").count()
    write_clustered(rows.filter("false"), str(tmp_path / "empty"), ["stamp"])
