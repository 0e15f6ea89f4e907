"""The submitted jobs, end to end on the hand-written feeds."""

import os
import re

import pytest
from test_fixtures import make_lookups, write_sources

from sluice import jobs, schemas
from sluice.plans.feeds import FEEDS
from sluice.plans.reports import lake_reports
from sluice.plans.runs import run_all, run_feed_into_catalog
from sluice.session import build_session, sized_for
from sluice.sinks.catalog import set_up_tables
from sluice.sinks.landing import LANDING, land_in_table, landing_name
from sluice.streaming.ingest import ingest_feed


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    write_sources(base / "source")
    for name, frame in zip(("countries", "departments"), named_lookups(spark), strict=True):
        frame.coalesce(1).write.csv(str(base / name), header=True)
    return base


def named_lookups(spark):
    countries = [(code, f"Land {code}") for code in ("US", "FR", "DE")]
    departments = [(code, f"Office {code}") for code in ("HR", "IT")]
    return spark.createDataFrame(countries, schemas.COUNTRY_LOOKUP), spark.createDataFrame(departments, schemas.DEPARTMENT_LOOKUP)


def test_round_and_report(spark, folders, capsys):
    lookups = ["--countries", str(folders / "countries"), "--departments", str(folders / "departments")]
    lake = ["--lake", str(folders / "lake")]
    jobs.main(["round", "--source", str(folders / "source"), *lake, *lookups, "--buckets", "2"])
    jobs.main(["round", "--source", str(folders / "source"), *lake, *lookups])
    assert re.findall(r"orders: .*", capsys.readouterr().out) == ["orders: version 1", "orders: nothing new"]
    jobs.main(["report", *lake, *lookups])
    assert "top_countries" in capsys.readouterr().out
    reports = lake_reports(spark, str(folders / "lake"), *named_lookups(spark))
    counts = {(r.feed, r.layer): r.rows for r in reports["layer_counts"].collect()}
    assert counts["orders", "raw"] == 12 == counts["orders", "structured"] + counts["orders", "rejected"]
    assert float(reports["total_sales"].first()[0]) == round(7 * 49.99, 2)
    assert [tuple(r) for r in reports["sales_by_region"].collect()][0][0] == "North America"
    assert {r.feed: round(r.rejection_rate, 2) for r in reports["rejection_rates"].collect()}["orders"] == 75.0
    assert reports["ingest_batches"].first().ingest_batches == 1


def test_catalog_lake(spark, folders, tmp_path):
    names = set_up_tables(spark, str(tmp_path), prefix="jobs_")
    assert set_up_tables(spark, str(tmp_path), prefix="jobs_") == names
    for name, feed in FEEDS.items():
        ingest_feed(spark, feed, f"{folders}/source/{name}", f"{tmp_path}/checkpoint/{name}", table=f"jobs_raw.{name}")
        for _ in range(2):
            run_feed_into_catalog(
                feed, f"jobs_raw.{name}", f"jobs_structured.{name}", f"jobs_structured.{name}_rejected", make_lookups(spark)
            )
    for name, rows in {"customers": (4, 5), "orders": (3, 9), "products": (4, 5)}.items():
        kept, rejected = spark.table(f"jobs_structured.{name}"), spark.table(f"jobs_structured.{name}_rejected")
        assert (kept.count(), rejected.count()) == rows


def test_catalog_round_is_incremental_and_repeatable(spark, folders, tmp_path):
    set_up_tables(spark, str(tmp_path), prefix="again_")
    names = ["again_raw.customers", "again_structured.customers", "again_structured.customers_rejected"]

    def run(mode="incremental"):
        counts = run_feed_into_catalog(FEEDS["customers"], *names, make_lookups(spark), spark=spark, mode=mode)
        return counts, spark.table(names[1]).count(), spark.table(names[2]).count()

    ingest_feed(spark, FEEDS["customers"], f"{folders}/source/customers", f"{tmp_path}/c", table=names[0])
    counts, kept, rejected = run()
    assert (counts["rows"], counts["clean"], kept, rejected) == (9, 4, 4, 5)
    assert run() == (None, 4, 5)
    land_in_table(spark.table(names[0]).filter("customer_id = 'C3'").drop(LANDING), names[0], landing_name("other", 0))
    assert run()[1:] == (4, 6)
    assert run("full")[1:] == (4, 6)


def test_a_feed_without_files_holds_up_no_other(spark, tmp_path):
    write_sources(tmp_path / "source")
    (tmp_path / "source" / "orders").rename(tmp_path / "elsewhere")
    lookups = make_lookups(spark)
    rounds = run_all(spark, str(tmp_path / "source"), str(tmp_path / "lake"), lookups)
    assert rounds["orders"] is None and rounds["customers"].version == 1
    reports = lake_reports(spark, str(tmp_path / "lake"), *named_lookups(spark))
    counts = {(r.feed, r.layer): r.rows for r in reports["layer_counts"].collect()}
    assert counts["orders", "raw"] == counts["orders", "structured"] == counts["orders", "rejected"] == 0
    assert counts["customers", "raw"] == 9
    assert reports["total_sales"].first()[0] == 0 and reports["sales_by_region"].count() == 0
    (tmp_path / "elsewhere").rename(tmp_path / "source" / "orders")
    assert run_all(spark, str(tmp_path / "source"), str(tmp_path / "lake"), lookups)["orders"].version == 1


def test_settings_follow_the_data():
    settings = sized_for(input_bytes=100 * 10**12, cores=8000)
    assert 40_000 < int(settings["spark.sql.shuffle.partitions"]) <= 52_000
    assert int(settings["spark.sql.files.maxPartitionBytes"]) >= 10**9
    assert sized_for(input_bytes=10**9, cores=8)["spark.sql.shuffle.partitions"] == "24"


def test_scratch_folder_is_the_sessions(spark):
    from sluice.storage import scratch_path

    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert build_session("again").sparkContext is spark.sparkContext and os.path.sep in scratch_path(spark, "y")
