"""Ingestion: drains, new files, failures, and upsert from a stream."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.plans.feeds import ORDERS
from sluice.schemas import INSERTED_AT
from sluice.sinks.catalog import set_up_tables
from sluice.sinks.landing import land_in_folder, landing_name, not_seen, read_landed, widen_folder
from sluice.sinks.snapshot import SnapshotTable
from sluice.sources.csv import read_feed_stream
from sluice.sources.tables import preview, read_table, read_table_incremental
from sluice.streaming.ingest import append_stream, ingest_feed, stamp, upsert_stream

HEADER = "order_id,customer_id,product_id,order_date,quantity\n"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))


def test_drains_into_a_catalog_table(spark, tmp_path):
    set_up_tables(spark, str(tmp_path / "db"), prefix="drain_")
    source, table = tmp_path / "source", "drain_raw.orders"

    def drain():
        ingest_feed(spark, ORDERS, str(source), str(tmp_path / "checkpoint"), table=table, max_files_per_trigger=1)
        return spark.table(table).count()

    put(source, "a.csv", "O1,C1,P1,2024-01-01,5", "O2,C1,P1,INVALID_DATE,5")
    assert drain() == 2
    assert drain() == 2
    put(source, "b.csv", "O3,C1,P1,2024-01-02,1")
    assert drain() == 3
    rows = {r.order_id: r for r in spark.table(table).collect()}
    assert rows["O2"]._corrupt_records == "O2,C1,P1,INVALID_DATE,5" and rows["O2"].quantity == 5
    assert rows["O1"]._corrupt_records is None
    assert rows["O1"][INSERTED_AT] == rows["O2"][INSERTED_AT] < rows["O3"][INSERTED_AT]

    newer = read_table_incremental(spark, table, INSERTED_AT, rows["O1"][INSERTED_AT], ["order_id"])
    assert [r.order_id for r in newer.collect()] == ["O3"]
    assert read_table_incremental(spark, table, INSERTED_AT).count() == 3
    assert read_table(spark, table, ["order_id"], "quantity > 4 AND _corrupt_records IS NULL").collect() == [("O1",)]
    assert preview(spark, f"SELECT * FROM {table}", rows=2).count() == 2


def test_failed_sink_is_taken_up_again(spark, tmp_path):
    put(tmp_path / "source", "a.csv", "O1,C1,P1,2024-01-01,5")
    stream = read_feed_stream(spark, str(tmp_path / "source"), ORDERS.schema)
    seen, fail = [], [True]

    def sink(batch, batch_id):
        if fail:
            fail.clear()
            raise RuntimeError("sink lost")
        seen.extend((batch_id, r.order_id) for r in batch.collect())

    def drain():
        writer = stamp(stream).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="sink lost"):
        drain()
    drain()
    drain()
    assert seen == [(0, "O1")]


def test_stream_upsert_skips_a_replayed_batch(spark, tmp_path):
    source = tmp_path / "source"
    target = SnapshotTable(spark, str(tmp_path / "table"), "order_id", n_buckets=2)
    order = [F.desc("quantity")]

    def drain(checkpoint):
        stream = read_feed_stream(spark, str(source), ORDERS.schema)
        upsert_stream(stream, target, order, str(tmp_path / checkpoint))
        return {r.order_id: r.quantity for r in target.read().collect()}

    put(source, "a.csv", "O1,C,P,2024-01-01,5", "O1,C,P,2024-01-01,6", "O2,C,P,2024-01-01,1")
    assert drain("one") == {"O1": 6, "O2": 1}
    put(source, "b.csv", "O2,C,P,2024-01-01,9")
    assert drain("one") == {"O1": 6, "O2": 9}
    put(source, "c.csv", "O1,C,P,2024-01-01,2", "O3,C,P,2024-01-01,1")  # late: O1 already has more
    assert drain("one") == {"O1": 6, "O2": 9, "O3": 1}
    # A stream with a checkpoint of its own is read from its start, and changes nothing it did not win.
    assert drain("two") == {"O1": 6, "O2": 9, "O3": 1}
    assert len(target.current().state["stream_batches"]) == 2
    # A batch whose number was published is not applied again.
    state = json.loads((tmp_path / "one" / "metadata").read_text())["id"]
    version = target.current().version
    for name in ("2", ".2.crc"):
        (tmp_path / "one" / "commits" / name).unlink(missing_ok=True)
    assert drain("one") == {"O1": 6, "O2": 9, "O3": 1}
    assert target.current().version == version and target.current().state["stream_batches"][state] == 2


def test_stream_upsert_refuses_null_keys(spark, tmp_path):
    put(tmp_path / "source", "a.csv", ",C,P,2024-01-01,5")
    stream = read_feed_stream(spark, str(tmp_path / "source"), ORDERS.schema)
    target = SnapshotTable(spark, str(tmp_path / "table"), "order_id", n_buckets=2)
    with pytest.raises(Exception, match="has no order_id"):
        upsert_stream(stream, target, [F.desc("quantity")], str(tmp_path / "checkpoint"))
    assert target.current() is None


def test_folder_and_table_widen(spark, tmp_path):
    spark.sql(f"CREATE DATABASE widening LOCATION '{tmp_path}/db'")
    for step, rows in enumerate(("SELECT 1 AS a", "SELECT 2 AS a, 'x' AS b", "SELECT 3 AS a")):
        spark.sql(rows).write.parquet(f"{tmp_path}/in/{step}")
        for where in ({"path": f"{tmp_path}/raw"}, {"table": "widening.t"}):
            schema = spark.read.parquet(f"{tmp_path}/in/{step}").schema
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/{step}")
            append_stream(stream, f"{tmp_path}/c{step}{list(where)[0]}", **where)
    for frame in (read_landed(spark, f"{tmp_path}/raw"), spark.table("widening.t")):
        assert sorted((r.a, r.b) for r in frame.collect()) == [(1, None), (2, "x"), (3, None)]
    spark.sql("SELECT 'text' AS a").write.parquet(f"{tmp_path}/in/bad")
    stream = spark.readStream.schema("a string").parquet(f"{tmp_path}/in/bad")
    with pytest.raises(ValueError, match="another type"):
        append_stream(stream, f"{tmp_path}/cbad", path=f"{tmp_path}/raw")


def test_a_repeated_batch_replaces_its_landing(spark, tmp_path):
    rows = spark.sql("SELECT 1 AS a")
    widen_folder(spark, str(tmp_path / "raw"), rows.schema)
    for _ in range(2):
        land_in_folder(rows, str(tmp_path / "raw"), landing_name("s", 0))
    assert read_landed(spark, str(tmp_path / "raw")).count() == 1
    frame = read_landed(spark, str(tmp_path / "raw")).filter(not_seen({"s": 0}))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 0 and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_header_is_ignored_unless_asked_for(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "a.csv").write_text("customer_id,order_id,product_id,order_date,quantity\nO1,C1,P1,2024-01-01,5\n")
    ingest_feed(spark, ORDERS, str(source), str(tmp_path / "c1"), path=str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).first().order_id == "O1"
    with pytest.raises(Exception, match="header"):
        ingest_feed(spark, ORDERS, str(source), str(tmp_path / "c2"), path=str(tmp_path / "raw2"), match_header=True)


def test_backlog_is_cut_into_batches(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.csv"):
        put(tmp_path / "source", name, f"{name},C,P,2024-01-01,5")
    ingest_feed(
        spark, ORDERS, str(tmp_path / "source"), str(tmp_path / "c"), path=str(tmp_path / "raw"), max_bytes_per_trigger=1
    )
    assert spark.read.parquet(str(tmp_path / "raw")).select(INSERTED_AT).distinct().count() == 3
