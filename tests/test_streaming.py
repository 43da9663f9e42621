import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.operators import checks, loads
from roomledger.operators.lookup import Dimension
from roomledger.plans import silver
from roomledger.plans.lakehouse import Lakehouse
from roomledger.session import work_folder
from roomledger.sources import files
from roomledger.streaming import bronze
from roomledger.streaming import silver as silver_stream


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def feed(spark, first, rows, year):
    values = {
        "booking_id": F.col("id"),
        "date_key": F.lit(year * 10000 + 101),
        "hotel": F.when(F.col("id") % 2 == 0, "City Hotel").otherwise("Lost Hotel"),
        "country": F.when(F.col("id") % 3 != 0, "PRT"),
        "reserved_room_type": F.lit("A"),
        "adr": F.lit(10.5),
        "arrival_date_year": F.lit(year),
    }
    return spark.range(first, first + rows, 1, 2).select(
        *[
            values.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in schemas.FEED.items()
        ]
    )


def dimensions(spark):
    def rows(ddl, *values):
        return Dimension.counted(spark.createDataFrame(list(values), ddl))

    return silver.Dimensions(
        date=rows(
            "date_key int, full_date string, month_name string, month_number int, "
            "quarter int, year int, day_name string, is_weekend int",
            (20150101, "2015-01-01", "January", 1, 1, 2015, "Thursday", 0),
        ),
        hotel=rows("hotel_key int, hotel_name string, hotel_type string", (2, "City Hotel", "City")),
        guest_origin=rows("guest_origin_key int, country_code string", (7, "PRT")),
        room_type=rows(
            "room_type_key int, room_code string, room_name string, base_rate_tier string",
            (1, "A", "Standard Room", "Standard"),
        ),
    )


@pytest.fixture
def lake(spark):
    return Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)


def run(spark, lake, limits=bronze.BatchLimits()):
    """Ingest, and the number of micro-batches that had rows."""
    path, checkpoint = lake.path("bronze"), lake.checkpoint("bronze")
    query = bronze.ingest(spark, lake.interval_files, path, checkpoint, limits)
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)


def test_each_interval_once(spark, lake):
    path = lake.path("bronze")
    loads.write_intervals(feed(spark, 0, 30, 2015), lake.intervals)
    assert run(spark, lake) == 1
    loads.write_intervals(feed(spark, 100, 20, 2016), lake.intervals)
    assert run(spark, lake) == 1
    assert run(spark, lake) == 0
    stored = bronze.read_bronze(spark, path)
    assert stored.columns == list(schemas.BRONZE)
    assert table(checks.rows_by_source(stored)) == [
        ("fact_stream_2015.json", 30),
        ("fact_stream_2016.json", 20),
    ]
    assert stored.filter(F.col("_ingest_timestamp").isNull()).count() == 0
    assert stored.select("_ingest_timestamp").distinct().count() == 2
    batch = files.read_feed(spark, lake.interval_files)
    assert table(stored.select(*schemas.FEED)) == table(batch)
    assert table(batch) == table(feed(spark, 0, 30, 2015).union(feed(spark, 100, 20, 2016)))


def test_a_late_file_of_an_old_interval_is_picked_up(spark, lake):
    loads.write_intervals(feed(spark, 0, 10, 2015), lake.intervals)
    run(spark, lake)
    loads.write_intervals(feed(spark, 50, 5, 2015), lake.intervals)
    run(spark, lake)
    assert bronze.read_bronze(spark, lake.path("bronze")).count() == 15


def test_a_batch_that_was_not_committed_is_not_written_twice(spark, lake):
    """As after a driver lost between writing a batch and noting it as done."""
    loads.write_intervals(feed(spark, 0, 30, 2015), lake.intervals)
    run(spark, lake)
    commits = Path(lake.checkpoint("bronze")) / "commits"
    last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    loads.write_intervals(feed(spark, 100, 20, 2016), lake.intervals)
    run(spark, lake)
    stored = bronze.read_bronze(spark, lake.path("bronze"))
    assert (stored.count(), stored.select("booking_id").distinct().count()) == (50, 50)


def test_batches_can_be_limited(spark, lake):
    for year in (2015, 2016, 2017):
        loads.write_intervals(feed(spark, year, 4, year).coalesce(1), lake.intervals)
    assert run(spark, lake, bronze.BatchLimits(files=1)) == 3
    assert bronze.read_bronze(spark, lake.path("bronze")).count() == 12


def test_single_files_named_after_the_year(spark, lake, tmp_path):
    line = '{"booking_id": 1, "adults": "2", "children": 2.0, "babies": 1, "arrival_date_year": 2015}'
    (tmp_path / "fact_stream_2015.json").write_text(line + "\n")
    (tmp_path / "other.json").write_text("{}\n")
    path, checkpoint = lake.path("bronze"), lake.checkpoint("bronze")
    bronze.ingest(spark, str(tmp_path / "fact_stream_*.json"), path, checkpoint)
    rows = bronze.read_bronze(spark, path).collect()
    assert [(r._source_file, r.booking_id) for r in rows] == [("fact_stream_2015.json", 1)]
    assert (rows[0].adults, rows[0].children, rows[0].babies) == (None, None, 1)


def test_silver_refresh_adds_new_bronze_rows_only(spark, lake):
    dims, path = dimensions(spark), lake.path("silver")

    def refresh():
        run(spark, lake)
        query = silver_stream.refresh(
            spark, lake.path("bronze"), path, lake.checkpoint("silver"), dims
        )
        return sum(p["numInputRows"] for p in query.recentProgress)

    loads.write_intervals(feed(spark, 0, 30, 2015), lake.intervals)
    assert refresh() == 30
    loads.write_intervals(feed(spark, 100, 20, 2016), lake.intervals)
    assert refresh() == 20
    assert refresh() == 0
    streamed = silver_stream.read_silver(spark, path)
    batch = silver.enrich(bronze.read_bronze(spark, lake.path("bronze")), dims)
    assert streamed.columns == batch.columns == list(schemas.SILVER)
    assert table(streamed) == table(batch)


def test_unmatched_facts_keep_their_row(spark):
    facts = feed(spark, 0, 6, 2015).union(feed(spark, 10, 1, 2016)).select(
        "*",
        F.current_timestamp().alias("_ingest_timestamp"),
        F.lit("").alias("_source_file"),
    )
    dims = dimensions(spark)
    rows = {r.booking_id: r for r in silver.enrich(facts, dims).collect()}
    assert len(rows) == 7
    matched, lost, late = rows[2], rows[3], rows[10]
    assert (matched.hotel_key, matched.guest_origin_key, matched.room_type_key) == (2, 7, 1)
    assert (lost.hotel_key, lost.hotel_name, lost.guest_origin_key, lost.country_code) == (
        0,
        None,
        0,
        None,
    )
    assert (late.date_key, late.full_date, late.year) == (20160101, None, None)
    counts = checks.unresolved_keys(silver.enrich(facts, dims)).first()
    assert tuple(counts) == (7, 3, 2, 0, 1)
    assert tuple(checks.null_keys(silver.enrich(facts, dims)).first()) == (7, 0, 0, 0, 0)
