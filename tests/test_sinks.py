"""Upsert, append, quarantine and catalog sinks."""

import pytest
from pyspark.sql import functions as F

from sluice import storage
from sluice.sinks import append
from sluice.sinks.catalog import TABLES, set_up_tables
from sluice.sinks.snapshot import SnapshotTable


def keyed(spark, values, columns="k string, v string"):
    return spark.createDataFrame(values, columns)


def content(frame):
    return {row[0]: tuple(row[1:]) for row in frame.collect()}


def test_upsert(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=4)
    with pytest.raises(FileNotFoundError):
        target.read()
    target.upsert(keyed(spark, [("A", "old"), ("B", "old")]))
    target.upsert(keyed(spark, [("B", "new"), ("C", "new")]))
    assert content(target.read()) == {"A": ("old",), "B": ("new",), "C": ("new",)}
    target.upsert(keyed(spark, []))
    assert content(target.read()) == {"A": ("old",), "B": ("new",), "C": ("new",)}
    assert target.current().version == 3


@pytest.mark.parametrize("rows", [[("A", "1"), ("A", "2")], [(None, "1")]])
def test_upsert_refuses_bad_keys(spark, tmp_path, rows):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=2)
    with pytest.raises(ValueError, match="NULL or repeated"):
        target.upsert(keyed(spark, rows))
    assert target.current() is None


def test_upsert_rewrites_only_what_it_replaces(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=4, max_segments=3)
    many = spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("old").alias("v"))
    assert target.upsert(many).segments == [[1, b] for b in range(4)]
    snapshot = target.upsert(keyed(spark, [("k7", "new")]))
    assert sorted(v for v, _ in snapshot.segments) == [1, 1, 1, 2]
    assert target.read().count() == 200 and content(target.read())["k7"] == ("new",)

    more = spark.range(200, 300).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("more").alias("v"))
    snapshot = target.upsert(more)
    assert sorted(v for v, _ in snapshot.segments) == [1, 1, 1, 2, 3, 3, 3, 3]
    for start in (300, 400):
        more = spark.range(start, start + 100).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("more").alias("v"))
        snapshot = target.upsert(more)
    assert sorted(v for v, _ in snapshot.segments) == [5, 5, 5, 5]
    assert target.read().count() == 500 == target.read().select("k").distinct().count()


def test_bucket_is_the_hash_of_a_shuffle(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=8)
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"))
    placed = rows.repartition(8, "k").filter(F.spark_partition_id() != target.bucket_of_key(8))
    assert placed.count() == 0


@pytest.mark.parametrize("n_buckets", [4, 3])
def test_update_of_all_rows_writes_few_files_per_bucket(spark, tmp_path, n_buckets):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=n_buckets)
    rows = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        target.upsert(rows)
        target.upsert(rows.filter("k < 1000").withColumn("v", F.lit("y")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = target.read().select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 3 * 8 and target.read().filter("v = 'y'").count() == 1000 == target.read().filter("v = 'x'").count()


def test_new_columns_widen_the_table_and_lost_ones_are_refused(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=2)
    target.upsert(keyed(spark, [("A", "1"), ("B", "2")]))
    target.upsert(keyed(spark, [("B", "3", 7)], "k string, v string, w int"))
    assert content(target.read()) == {"A": ("1", None), "B": ("3", 7)}
    with pytest.raises(ValueError, match="lack columns"):
        target.upsert(keyed(spark, [("A", "1")]))


def test_unpublished_version_is_invisible_and_rewritten(spark, tmp_path, monkeypatch):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=2)
    target.upsert(keyed(spark, [("A", "1")]))
    with monkeypatch.context() as patch:
        patch.setattr(storage, "publish_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            target.upsert(keyed(spark, [("A", "2"), ("B", "2")]))
    assert content(target.read()) == {"A": ("1",)}
    target.upsert(keyed(spark, [("C", "3")]))
    assert content(target.read()) == {"A": ("1",), "C": ("3",)}


def test_a_version_is_published_once(spark, tmp_path):
    path = str(tmp_path / "p" / "1.json")
    storage.publish_text(spark, path, "one")
    with pytest.raises(FileExistsError):
        storage.publish_text(spark, path, "two")
    assert storage.read_text(spark, path) == "one"
    assert storage.child_names(spark, str(tmp_path / "p")) in (["1.json"], [".1.json.crc", "1.json"])


def test_remove_superseded(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=4, partition_by=["v"])
    for value in ("1", "2", "3"):
        target.upsert(spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit(value).alias("v")))
    target.remove_superseded(keep=1)
    assert storage.child_names(spark, f"{tmp_path}/t/data/_version=1") in ([], ["_SUCCESS"], ["._SUCCESS.crc", "_SUCCESS"])
    assert target.read().filter("v = '3'").count() == 40


def test_catalog_set_up_is_idempotent(spark, tmp_path):
    names = set_up_tables(spark, str(tmp_path), prefix="idem_")
    append.write_append(spark.createDataFrame([("P1", 2.0)], "product_id string, price double"), "idem_raw.products")
    assert set_up_tables(spark, str(tmp_path), prefix="idem_") == names
    assert [f"idem_{name}" for name in TABLES] == names
    assert spark.table("idem_raw.products").count() == 1
    for name, schema in TABLES.items():
        found = spark.table(f"idem_{name}").drop("_landing").schema
        assert ("_landing" in spark.table(f"idem_{name}").columns) == name.startswith("raw.")
        assert [(f.name, f.dataType) for f in found.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_append_by_name_widens_and_fills(spark, tmp_path):
    spark.sql(f"CREATE DATABASE append_db LOCATION '{tmp_path}'")
    append.write_append(keyed(spark, [("A", "1")]), "append_db.t")
    append.write_append(spark.createDataFrame([(5, "B")], "extra int, k string"), "append_db.t")
    assert content(spark.table("append_db.t")) == {"A": ("1", None), "B": (None, 5)}


def test_quarantine(spark, tmp_path):
    spark.sql(f"CREATE DATABASE quarantine_db LOCATION '{tmp_path}'")
    rows = keyed(spark, [("A", "1")])
    append.write_rejected_records(rows, "quarantine_db.t", "Duplicate record")
    append.write_rejected_records(rows.filter("false"), "quarantine_db.t", "Data quality check failed")
    found = spark.table("quarantine_db.t").collect()
    assert [r.rejection_reason for r in found] == ["Duplicate record"] and found[0].rejected_at is not None


def test_merge_into_catalog_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE merge_db LOCATION '{tmp_path}'")
    append.write_append(keyed(spark, [("A", "old"), ("B", "old")]), "merge_db.t")
    append.write_merge(keyed(spark, [("B", "new"), ("C", "new")]), "merge_db.t", "k")
    append.write_merge(keyed(spark, [("C", "newer", 1)], "k string, v string, w int"), "merge_db.t", "k")
    assert content(spark.table("merge_db.t")) == {"A": ("old", None), "B": ("new", None), "C": ("newer", 1)}
    with pytest.raises(ValueError):
        append.write_merge(keyed(spark, [("B", "1"), ("B", "2")]), "merge_db.t", "k")


def test_refused_upserts_leave_the_old_version_readable(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "typed"), "k", n_buckets=2)
    table.upsert(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(ValueError, match="another type"):
        table.upsert(spark.createDataFrame([(2, "b")], "k long, v string"))
    with pytest.raises(ValueError, match="lack columns"):
        table.upsert(spark.createDataFrame([(2,)], "k int"))
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")] and table.current().version == 1
    table.upsert(spark.createDataFrame([(3, "c", 1.5)], "k short, v string, w double"))
    assert sorted(map(tuple, table.read().collect())) == [(1, "a", None), (3, "c", 1.5)]
    assert dict(table.read().dtypes)["k"] == "int"


def test_rebucketed_rows_are_the_same(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "grown"), "k", n_buckets=2)
    for n in (1, 2):
        table.upsert(spark.range(50 * n).selectExpr("id AS k", f"{n} AS v"))
    before = sorted(map(tuple, table.read().collect()))
    assert table.rebucket(7).n_buckets == 7
    assert sorted(map(tuple, table.read().collect())) == before
    table.upsert(spark.range(3).selectExpr("id AS k", "9 AS v"))
    assert sorted(map(tuple, table.read().collect())) == [(k, 9 if k < 3 else 2) for k in range(100)]


def test_append_refuses_a_changed_type(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS typed LOCATION '{tmp_path}'")
    append.write_append(spark.sql("SELECT 1 AS a, 'x' AS b"), "typed.t")
    with pytest.raises(ValueError, match="another type"):
        append.write_append(spark.sql("SELECT 1.5D AS a, 'x' AS b"), "typed.t")
    append.write_append(spark.sql("SELECT 2S AS a, true AS c"), "typed.t")
    assert sorted(map(str, spark.table("typed.t").collect())) == sorted(
        ["Row(a=1, b='x', c=None)", "Row(a=2, b=None, c=True)"]
    )
