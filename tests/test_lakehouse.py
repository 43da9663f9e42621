"""The stored tables end to end, and the shape of the plans behind them."""

import os
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.catalog import queries, sample
from roomledger.operators import loads
from roomledger.plans import gold, lakehouse, reports
from roomledger.session import work_folder
from roomledger.sources import files
from roomledger.streaming import bronze
from roomledger.streaming import silver as silver_stream

SF_DIR = "/root/testdata/sf0.001"


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    registry = lakehouse.build(
        spark,
        lake,
        raw=sample.bookings(spark, SF_DIR),
        hotels=sample.hotels(spark),
        room_types=sample.room_types(spark),
        profiles=sample.guest_profiles(spark, SF_DIR),
        tie_breakers=sample.TIE_BREAKERS,
    )
    return lake, registry


@pytest.fixture(scope="module")
def stored_silver(spark, built):
    return silver_stream.read_silver(spark, built[0].path(lakehouse.SILVER))


def test_building_again_adds_nothing(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    sources = {
        "raw": sample.bookings(spark, SF_DIR),
        "hotels": sample.hotels(spark),
        "room_types": sample.room_types(spark),
        "profiles": sample.guest_profiles(spark, SF_DIR),
    }
    first = table(lakehouse.build(spark, lake, **sources))
    ids = spark.read.parquet(lake.path(lakehouse.BRONZE)).agg(F.max("booking_id")).first()[0]
    assert table(lakehouse.build(spark, lake, **sources)) == first
    assert ids == 6000


def new_lake(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


def test_a_feed_cut_short_lands_what_is_missing(spark):
    lake, raw = new_lake(spark), sample.bookings(spark, SF_DIR)
    lakehouse.land_feed(raw, lake, sample.TIE_BREAKERS, unique=True)
    assert not any("landed" in str(p) for p in Path(lake.base).rglob("*"))
    assert lakehouse.load_bronze(spark, lake).count() == 6000
    for file in [*Path(lake.intervals).rglob("_SUCCESS"), *Path(lake.manifest).glob("part-*")]:
        if file.name == "_SUCCESS" or '"done":true' in file.read_text():
            file.unlink()
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    other = raw.limit(7)
    with pytest.raises(ValueError, match="in part"):
        lakehouse.land_feed(other, lake)
    lakehouse.land_feed(raw, lake, sample.TIE_BREAKERS)
    assert lakehouse.load_bronze(spark, lake).count() == 6000
    lakehouse.land_feed(other, lake)
    lakehouse.land_feed(other, lake)
    ids = lakehouse.load_bronze(spark, lake, bronze.BatchLimits(files=2)).agg(
        F.count("*"), F.min("booking_id"), F.max("booking_id"), F.count_distinct("booking_id")
    )
    assert tuple(ids.first()) == (6007, 1, 6007, 6007)


def test_intervals_may_be_repeated_and_have_no_year(spark):
    lake = new_lake(spark)
    bookings = spark.range(5).selectExpr(
        *[f"cast({'id' if n == 'booking_id' else 'if(id < 3, 2015, NULL)' if n == 'arrival_date_year' else 'NULL'} as {t}) as {n}"
          for n, t in schemas.FEED.items()]
    )
    assert lakehouse.load_bronze_by_interval(bookings, lake, []).count() == 0
    assert lakehouse.load_bronze_by_interval(bookings, lake, [None, 2015, 2015, None]).count() == 5
    assert lakehouse.load_bronze_by_interval(bookings, lake, []).count() == 5


def test_files_with_an_old_time_are_read(spark):
    lake = new_lake(spark)
    for name, age in (("a", 0), ("b", 9 * 86400)):
        folder = Path(lake.intervals) / "feed=x" / "interval_year=2015"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text('{"booking_id": 1, "arrival_date_year": 2015}\n')
        now = time.time() - age
        os.utime(folder / f"{name}.json", (now, now))
        stored = lakehouse.load_bronze(spark, lake)
    assert stored.count() == 2


def test_registry_lists_every_table(built):
    lake, registry = built
    rows = {r.table_name: r for r in registry.collect()}
    assert list(rows) == list(lake.tables())
    assert all(r.error is None for r in rows.values())
    assert rows["bronze_fact_bookings"].rows == rows["silver_fact_bookings_enriched"].rows == 6000


def test_tables_are_found_by_name(spark, built):
    lake, registry = built
    for row in registry.collect():
        assert spark.table(lake.table(row.table_name)).count() == row.rows


def test_bronze_ids_are_consecutive(spark, built):
    ids = bronze.read_bronze(spark, built[0].path(lakehouse.BRONZE)).agg(
        F.min("booking_id"), F.max("booking_id"), F.count_distinct("booking_id")
    )
    assert tuple(ids.first()) == (1, 6000, 6000)


def test_gold_counts_add_up_to_silver(spark, built, stored_silver):
    lake = built[0]
    revenue = spark.read.parquet(lake.path("gold_revenue_by_hotel_year"))
    assert revenue.agg(F.sum("total_bookings")).first()[0] == stored_silver.count()
    rooms = spark.read.parquet(lake.path("gold_room_type_performance"))
    assert rooms.agg(F.sum("total_bookings")).first()[0] == gold.completed_stays(stored_silver).count()


def test_stored_tables_equal_the_lazy_plans(spark, built, stored_silver):
    lake = built[0]
    for name, query in {
        "gold_revenue_by_hotel_year": queries.gold_revenue_by_hotel_year,
        "gold_top_countries_revenue": queries.gold_top_countries,
        "gold_room_type_performance": queries.gold_room_performance,
    }.items():
        assert table(spark.read.parquet(lake.path(name))) == table(query(spark, SF_DIR))
    lazy = queries.silver_enriched(spark, SF_DIR)
    assert table(stored_silver.drop("_ingest_timestamp")) == table(lazy)


def test_reports_by_table_name(spark, built, stored_silver):
    lake = built[0]
    silver_name = lake.table(lakehouse.SILVER)
    monthly = reports.monthly_bookings(spark, silver_name)
    assert table(monthly) == table(reports.monthly_bookings(spark, stored_silver))
    assert monthly.agg(F.sum("total_bookings")).first()[0] == 6000
    top = reports.leading_countries(spark, lake.table("gold_top_countries_revenue"), k=3)
    revenues = [r.total_revenue for r in top.collect()]
    assert len(revenues) == 3 and revenues == sorted(revenues, reverse=True)
    share = reports.weekend_share(spark, lake.table("gold_room_type_performance"))
    assert share.columns == [
        "room_name",
        "base_rate_tier",
        "total_bookings",
        "avg_weekend_nights",
        "avg_weekday_nights",
        "pct_weekend_stays",
        "avg_daily_rate",
        "total_revenue",
        "revenue_per_booking",
    ]
    quarterly = reports.quarterly_cancellations(
        spark, silver_name, sample.REPORT_COUNTRIES, sample.REPORT_YEAR, min_bookings=1
    )
    rows = quarterly.collect()
    assert rows and all(r.year == sample.REPORT_YEAR for r in rows)
    order = [(r.quarter, -r.cancel_pct) for r in rows]
    assert order == sorted(order)


def test_free_sql_on_stored_tables(spark, built):
    lake = built[0]
    found = spark.sql(
        f"SELECT count(*) FROM {lake.table(lakehouse.SILVER)} s "
        f"JOIN {lake.table('dim_date')} d ON s.date_key = d.date_key WHERE d.year = 1996"
    )
    assert found.first()[0] > 0


def test_a_new_hotel_may_stay_out_of_silver(spark, built):
    lake = built[0]
    for _ in range(2):
        loads.keyed_append(sample.new_hotels(spark), lake.path("dim_hotel"), "hotel_key")
    assert spark.read.parquet(lake.path("dim_hotel")).count() == 3
    assert lakehouse.stored_dimensions(spark, lake, last_hotel_key=2).hotel.rows == 2
    assert lakehouse.stored_dimensions(spark, lake).hotel.rows == 3


def test_streamed_silver_stands_beside_the_rebuilt_one(spark, built, stored_silver):
    lake = built[0]
    dims = lakehouse.stored_dimensions(spark, lake)
    for _ in range(2):
        streamed = lakehouse.refresh_silver(spark, lake, dims)
        assert table(streamed) == table(stored_silver)
    assert spark.table(lake.table(lakehouse.STREAMED_SILVER)).count() == 6000
    with pytest.raises(ValueError, match="written as a batch"):
        silver_stream.refresh(
            spark,
            lake.path(lakehouse.BRONZE),
            lake.path(lakehouse.SILVER),
            lake.checkpoint("other"),
            dims,
        )


# Plans.

def test_silver_joins_do_not_shuffle_the_fact(spark, built):
    lake = built[0]
    dims = lakehouse.stored_dimensions(spark, lake)
    facts = bronze.read_bronze(spark, lake.path(lakehouse.BRONZE))
    text = plan(lakehouse.silver.enrich(facts, dims))
    assert text.count("BroadcastHashJoin") == 4
    assert "Exchange hashpartitioning" not in text
    assert "SortMergeJoin" not in text


def test_reports_read_few_columns_and_prune_years(spark, stored_silver):
    text = plan(
        reports.quarterly_cancellations(
            spark, stored_silver, sample.REPORT_COUNTRIES, sample.REPORT_YEAR
        )
    )
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(year" in scan
    schema = stored_silver.select("booking_id").schema
    assert len(schema) == 1
    full = stored_silver._jdf.queryExecution().executedPlan().toString()
    assert scan.split("] Batched")[0].count("#") == 7 < full.split("] Batched")[0].count("#")


def test_completed_stays_are_filtered_in_the_scan(stored_silver):
    assert "EqualTo(is_canceled,0)" in plan(gold.room_performance(stored_silver))


def test_top_k_is_one_operator(stored_silver):
    text = plan(gold.top_countries(stored_silver))
    assert "TakeOrderedAndProject(limit=15" in text


def test_aggregates_are_combined_before_the_shuffle(stored_silver):
    text = plan(gold.revenue_by_hotel_year(stored_silver))
    assert "partial_sum(total_revenue" in text


def test_feed_has_the_declared_schema(spark):
    feed = queries.booking_feed(spark, SF_DIR)
    assert feed.dtypes == list(schemas.FEED.items())
