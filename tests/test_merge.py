"""Merges whose cost follows the change: what they read, what they write, and what they leave alone."""

import pytest
from pyspark.sql import functions as F

from sluice import storage
from sluice.operators import key_filter, quality
from sluice.operators.skew import lookup_join
from sluice.sinks import append, merge
from sluice.sinks.bucketed import create_bucketed, merge_bucketed, merged_in_buckets
from sluice.sinks.snapshot import SnapshotTable


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    name = "merges"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path_factory.mktemp('merges')}'")
    return name


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def files_by_partition(spark, table, column="p"):
    found = {}
    for file in spark.table(table).select(F.input_file_name().alias("f"), column).distinct().collect():
        found.setdefault(file[1], set()).add(file[0])
    return found


def content(spark, table):
    return {row["k"]: (row["v"], row["p"]) for row in spark.table(table).collect()}


def keyed_table(spark, database, name, partitions=10, rows=200):
    table = f"{database}.{name}"
    frame = spark.range(rows).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % partitions).cast("int").alias("p"))
    append.write_append(frame, table, ["p"])
    return table, {k: ("old", k % partitions) for k in range(rows)}


# -- partitions --------------------------------------------------------------


def test_merge_writes_only_partitions_that_hold_or_receive_a_key(spark, database):
    table, want = keyed_table(spark, database, "touched")
    before = files_by_partition(spark, table)
    # 13 stays in 3, 24 moves from 4 to 5, 999 is new in 7, and 1000 in a partition of its own.
    changes = [(13, "new", 3), (24, "new", 5), (999, "new", 7), (1000, "new", 77)]
    append.write_merge(spark.createDataFrame(changes, "k long, v string, p int"), table, "k")
    want |= {k: (v, p) for k, v, p in changes}
    assert content(spark, table) == want
    after = files_by_partition(spark, table)
    assert {p for p in after if after[p] != before.get(p)} == {3, 4, 5, 7, 77}
    # Partitions that were not touched keep their very files.
    assert all(after[p] == before[p] for p in (0, 1, 2, 6, 8, 9))


def test_merge_reads_whole_rows_of_touched_partitions_only(spark, database):
    table, _ = keyed_table(spark, database, "pruned")
    target = spark.table(table)
    source = spark.createDataFrame([(13, "new", 3), (24, "new", 5)], "k long, v string, p int")
    touched = merge.touched_partitions(target, source, "k", ["p"])
    assert {row["p"] for row in touched} == {3, 4, 5}
    assert {row["p"] for row in merge.touched_partitions(target, source, "k", ["p"], keys_stay=True)} == {3, 5}
    read = merge.rows_of_partitions(target, ["p"], touched)
    assert "PartitionFilters: [p#" in plan_of(read)
    assert {file.split("/p=")[1].split("/")[0] for file in read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"3", "4", "5"}
    held = target.select("k", "p").join(source.select("k"), "k", "left_semi")
    assert "ReadSchema: struct<k:bigint>" in plan_of(held)


def test_merges_alternate_between_two_slots(spark, database):
    table, want = keyed_table(spark, database, "slots", partitions=3, rows=30)
    location = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}["Location"]
    kept = []
    for step in range(5):
        before = files_by_partition(spark, table)
        append.write_merge(spark.createDataFrame([(4, f"v{step}", 1)], "k long, v string, p int"), table, "k")
        want[4] = (f"v{step}", 1)
        assert content(spark, table) == want
        # A reader that began before the merge finds its files.
        assert all(storage.exists(spark, file) for files in before.values() for file in files)
        kept.append(sum("p=1" in storage.child_names(spark, f"{location}.slots/_slot={slot}") for slot in "ab"))
        if step:
            assert not storage.exists(spark, f"{location}/p=1")
    assert kept == [1, 2, 2, 2, 2]
    append.write_append(spark.createDataFrame([(1_000, "appended", 1)], "k long, v string, p int"), table)
    assert content(spark, table)[1_000] == ("appended", 1) and content(spark, table)[4] == ("v4", 1)


def test_partitions_of_odd_values_and_emptied_ones(spark, database):
    table = f"{database}.odd"
    rows = [(1, "a", "x/y", 1), (2, "a", "it's", None), (3, "a", None, 2), (4, "a", "", 2), (5, "a", "100% {q}", 1)]
    schema = "k long, v string, p string, q int"
    append.write_append(spark.createDataFrame(rows, schema), table, ["p", "q"])
    changes = [(1, "b", "it's", None), (3, "b", None, 2), (6, "b", "", 2), (5, "b", "100% {q}", 1), (7, "b", "back\\slash", 9)]
    append.write_merge(spark.createDataFrame(changes, schema), table, "k")
    want = {1: ("b", "it's", None), 2: ("a", "it's", None), 3: ("b", None, 2), 4: ("a", None, 2)}
    want |= {5: ("b", "100% {q}", 1), 6: ("b", None, 2), 7: ("b", "back\\slash", 9)}
    assert {r.k: (r.v, r.p, r.q) for r in spark.table(table).collect()} == want
    names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert len(names) == 4 and not any("x%2Fy" in name for name in names)
    append.write_merge(spark.createDataFrame([], schema), table, "k")
    assert {r.k: (r.v, r.p, r.q) for r in spark.table(table).collect()} == want


def test_a_merge_that_fails_is_repeated_whole(spark, database, monkeypatch):
    table, want = keyed_table(spark, database, "failing", partitions=3, rows=30)
    changes = spark.createDataFrame([(4, "new", 1), (5, "new", 2), (99, "new", 8)], "k long, v string, p int")
    statements = []

    def lost(spark, path):
        statements.append(path)
        if len(statements) > 1:
            raise OSError("lost")
        return True

    with monkeypatch.context() as patch:
        patch.setattr(merge.storage, "exists", lost)
        with pytest.raises(OSError):
            append.write_merge(changes, table, "k")
    append.write_merge(changes, table, "k")
    want |= {4: ("new", 1), 5: ("new", 2), 99: ("new", 8)}
    assert content(spark, table) == want


# -- buckets -----------------------------------------------------------------


def test_bucketed_merge_moves_only_the_source(spark, database):
    table = f"{database}.bucketed"
    create_bucketed(spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v")), table, "k", 16)
    source = spark.range(490, 510).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    plan = plan_of(merged_in_buckets(spark.table(table), source, "k"))
    target = plan[plan.index("FileScan") - 400 : plan.index("FileScan")] if "FileScan" in plan else ""
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 16 out of 16" in plan
    assert "Exchange" not in target
    for step in range(3):
        merge_bucketed(source.withColumn("v", F.lit(f"new{step}")), table, "k")
        got = {row.k: row.v for row in spark.table(table).collect()}
        assert got == {k: "old" if k < 490 else f"new{step}" for k in range(510)}
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert files <= 16 and "Bucketed: true" in plan_of(spark.table(table).groupBy("k").count())
    merge_bucketed(spark.createDataFrame([(0, "w", 7)], "k long, v string, w int"), table, "k")
    assert spark.table(table).filter("k = 0").first().asDict() == {"k": 0, "v": "w", "w": 7}
    assert spark.table(table).filter("w is null").count() == 509
    assert spark.sql(f"SHOW TABLES IN {database} LIKE '*draft*'").count() == 0


def test_bucketed_merge_refuses_other_tables(spark, database):
    table, _ = keyed_table(spark, database, "plain", partitions=2, rows=4)
    with pytest.raises(ValueError, match="not bucketed"):
        merge_bucketed(spark.createDataFrame([(1, "x", 1)], "k long, v string, p int"), table, "k")


def test_null_stays_where_the_source_says_so(spark, database):
    table = f"{database}.nulls"
    create_bucketed(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), table, "k", 2)
    merge_bucketed(spark.createDataFrame([(1, None)], "k long, v string"), table, "k")
    assert {row.k: row.v for row in spark.table(table).collect()} == {1: None, 2: "b"}


# -- streams -----------------------------------------------------------------


def test_upsert_scans_only_touched_buckets(spark, tmp_path, monkeypatch):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=16)
    target.upsert(spark.range(400).select(F.col("id").alias("k"), F.lit(5).alias("v")))
    scanned = []
    plain = SnapshotTable._scan

    def recorded(self, snapshot, segments):
        scanned.extend(bucket for _, bucket in segments)
        return plain(self, snapshot, segments)

    monkeypatch.setattr(SnapshotTable, "_scan", recorded)
    batch = spark.createDataFrame([(7, 3), (8, 9), (1_000, 1)], "k long, v int")
    snapshot = target.upsert(batch, check_keys=False, first_by=[F.desc("v")])
    buckets = {row[0] for row in batch.select(F.pmod(F.hash("k"), F.lit(16))).collect()}
    assert set(scanned) == buckets and len(buckets) <= 3
    assert sum(version == 1 for version, _ in snapshot.segments) >= 13
    monkeypatch.undo()
    got = {row.k: row.v for row in target.read().collect()}
    assert got == {k: 5 for k in range(400)} | {8: 9, 1_000: 1}


def test_upsert_by_order_fills_columns_that_a_batch_lacks(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), "k", n_buckets=2)
    target.upsert(spark.createDataFrame([(1, 5, "w")], "k long, v int, w string"), first_by=[F.desc("v")])
    rows = target.filled(spark.createDataFrame([(1, 4), (2, 1)], "k long, v int"))
    target.upsert(rows, first_by=[F.desc("v")])
    assert {tuple(row) for row in target.read().select("k", "v", "w").collect()} == {(1, 5, "w"), (2, 1, None)}


# -- lookups -----------------------------------------------------------------


def test_filter_never_rules_out_a_key(spark):
    lookup = spark.range(0, 50_000, 5).select(F.concat(F.lit("k"), "id").alias("key"))
    facts = spark.range(100_000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), "id")).alias("key"), "id")
    tagged = key_filter.tag_possible(facts, "key", key_filter.filter_blocks(lookup, "key"), "may")
    held = F.expr("id < 50000 and id % 5 = 0 and id % 7 > 0")
    counts = tagged.agg(F.count_if(held & ~F.col("may")), F.count_if(~held & F.col("may")), F.count_if(F.expr("may and key is null"))).first()
    assert counts[0] == 0 and counts[1] < 0.03 * 100_000 and counts[2] == 0


def test_filter_is_bounded(spark):
    lookup = spark.range(10_000).withColumnRenamed("id", "key")
    blocks, number = key_filter.filter_blocks(lookup, "key", most_blocks=512)
    assert number == 512 and blocks.count() <= 512
    assert key_filter.filter_blocks(lookup, "key", most_blocks=256) is None
    assert key_filter.filter_blocks(lookup.filter("false"), "key")[0].count() == 0


def test_only_possible_hits_are_shuffled(spark):
    facts = spark.range(20_000).select((F.col("id") % 4_000).alias("key"), F.col("id").alias("row"))
    lookup = spark.range(0, 4_000, 40).select(F.col("id").alias("key"), F.lit(True).alias("found"))
    plain = lookup_join(facts, lookup, "key", max_broadcast_rows=0)
    joined = lookup_join(facts, lookup, "key", max_broadcast_rows=0, prefilter=True)
    assert sorted(map(tuple, joined.collect()), key=lambda r: r[1]) == sorted(map(tuple, plain.collect()), key=lambda r: r[1])
    assert joined.filter("found").count() == 500
    blocks = key_filter.filter_blocks(lookup, "key")
    assert key_filter.tag_possible(facts, "key", blocks, "may").filter("may").count() < 1_200


def test_integrity_check_with_a_filter(spark):
    facts = spark.createDataFrame([(1, " a "), (2, "b"), (3, None), (4, "zz")], "id int, code string")
    known = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    for prefilter in (False, True):
        checked = quality.check_referential_integrity(
            facts, known, "code", "code", normalize=True, max_broadcast_rows=0, prefilter=prefilter
        )
        assert {r.id: r.is_valid_ref for r in checked.collect()} == {1: "Y", 2: "Y", 3: "N", 4: "N"}
