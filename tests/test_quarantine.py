"""Damaged lines of feeds and documents, and facts whose member comes late."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger.operators import checks, loads
from roomledger.operators.lookup import Dimension
from roomledger.plans import lakehouse, silver
from roomledger.session import work_folder
from roomledger.sources import files
from roomledger.streaming import bronze, late
from tests.test_streaming import dimensions, feed, table


@pytest.fixture
def lake(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


def put(lake, name, *lines):
    folder = Path(lake.intervals) / "feed=x" / "interval_year=2015"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


WHOLE = '{"booking_id": 1, "adults": 2, "arrival_date_year": 2015}'
MISTYPED = '{"booking_id": 2, "adults": "two", "arrival_date_year": 2015}'
CUT_OFF = '{"booking_id": 3, "adul'
NO_JSON = "booking 4"
NO_ID = '{"booking_id": "five", "adults": 1, "arrival_date_year": 2015}'


def test_damaged_lines_are_set_aside(spark, lake):
    put(lake, "a.json", WHOLE, MISTYPED, CUT_OFF, "", NO_JSON, NO_ID)
    rows = lakehouse.load_bronze(spark, lake)
    assert sorted((r.booking_id, r.adults) for r in rows.collect()) == [(1, 2), (2, None)]
    assert rows.filter("booking_id IS NULL").count() == 0
    aside = bronze.read_quarantine(spark, lake.path(lakehouse.QUARANTINE)).collect()
    assert {r.line: r.kept for r in aside} == {MISTYPED: True, CUT_OFF: False, NO_JSON: False, NO_ID: False}
    assert all(r._source_path.endswith("a.json") and r._ingest_timestamp for r in aside)
    parsed = {r.line: json.loads(r.parsed) for r in aside}
    assert parsed[MISTYPED] == {"booking_id": 2, "arrival_date_year": 2015} and parsed[NO_ID]["adults"] == 1


def test_each_damaged_line_once(spark, lake):
    put(lake, "a.json", WHOLE, NO_JSON)
    for _ in range(2):
        lakehouse.load_bronze(spark, lake)
    put(lake, "b.json", NO_JSON, CUT_OFF)
    lakehouse.load_bronze(spark, lake)
    assert lakehouse.load_quarantine(spark, lake).count() == 3
    assert bronze.read_bronze(spark, lake.path(lakehouse.BRONZE)).count() == 1


def test_whole_feeds_start_no_second_stream(spark, lake):
    put(lake, "a.json", WHOLE)
    lakehouse.load_bronze(spark, lake)
    assert not Path(lake.path(lakehouse.QUARANTINE)).exists()
    assert bronze.read_quarantine(spark, lake.path(lakehouse.QUARANTINE)).count() == 0


def test_the_run_counts_its_lines(spark, lake):
    put(lake, "a.json", WHOLE, MISTYPED, CUT_OFF, NO_JSON)
    put(lake, "b.json", WHOLE)
    query = bronze.ingest(spark, lake.interval_files, lake.path("bronze"), lake.checkpoint("b"), bronze.BatchLimits(files=1))
    assert bronze.counted_lines(query) == {"read": 5, "damaged": 3, "refused": 2}
    assert bronze.saw_damage(query)


def test_damaged_documents(spark, tmp_path):
    lines = ['{"_id": "1", "country": "PRT", "previous_cancellations": 1}', "no document",
             '{"_id": "2", "country": "ESP", "previous_cancellations": "many"}', '{"country": "FR', "{}"]
    (tmp_path / "p.json").write_text("\n".join(lines) + "\n")
    found = files.read_documents(spark, str(tmp_path))
    assert found.columns == ["country", "previous_cancellations", "market_segment"]
    assert table(found.select("country")) == [("ESP",), ("PRT",), (None,)]
    assert files.count_documents(found) == 3
    aside = {r.line: r.kept for r in files.damaged_documents(spark, str(tmp_path)).collect()}
    assert aside == {lines[1]: False, lines[2]: True, lines[3]: False}


# Late members.

def stored(frame):
    return Dimension.counted(frame)


def grown(spark, dims):
    """The dimensions after the lost hotel and another year came."""
    hotel = spark.createDataFrame([(3, "Lost Hotel", "City")], dims.hotel.frame.schema)
    day = spark.createDataFrame(
        [(20160101, "2016-01-01", "January", 1, 1, 2016, "Friday", 0)], dims.date.frame.schema
    )
    return silver.Dimensions(
        date=stored(dims.date.frame.union(day)),
        hotel=stored(dims.hotel.frame.union(hotel)),
        guest_origin=dims.guest_origin,
        room_type=dims.room_type,
    )


def rebuilt(spark, lake, dims):
    return silver.enrich(bronze.read_bronze(spark, lake.path(lakehouse.BRONZE)), dims)


def test_late_members_are_joined_when_they_come(spark, lake):
    before = dimensions(spark)
    loads.write_intervals(feed(spark, 0, 30, 2015), lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lakehouse.refresh_silver(spark, lake, before)
    assert table(lakehouse.resolve_late(spark, lake, before)) == table(rebuilt(spark, lake, before))
    after = grown(spark, before)
    loads.write_intervals(feed(spark, 100, 20, 2016), lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lakehouse.refresh_silver(spark, lake, after)
    assert checks.unresolved_keys(lakehouse.streamed_silver(spark, lake)).first().unknown_hotel == 15
    for _ in range(2):
        whole = lakehouse.resolve_late(spark, lake, after)
        assert table(whole) == table(rebuilt(spark, lake, after))
    counts = checks.unresolved_keys(whole).first()
    assert (counts.total_rows, counts.unknown_hotel, counts.unknown_date) == (50, 0, 0)
    # Bookings without a country name no member: they are not pending.
    pending = spark.read.parquet(lake.path(lakehouse.PENDING))
    assert pending.count() == 15 and pending.filter("_hotel != 'Lost Hotel'").count() == 0


def test_dimensions_that_grow_between_the_runs_lose_nothing(spark, lake):
    """A run that is lost after Silver was streamed is made up for with larger dimensions."""
    before, after = dimensions(spark), grown(spark, dimensions(spark))
    loads.write_intervals(feed(spark, 0, 12, 2016), lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lakehouse.refresh_silver(spark, lake, before)
    assert lakehouse.streamed_silver(spark, lake).count() == 12
    assert table(lakehouse.resolve_late(spark, lake, after)) == table(rebuilt(spark, lake, after))


def test_settled_facts_are_not_shuffled(spark, lake):
    dims = dimensions(spark)
    loads.write_intervals(feed(spark, 0, 30, 2015), lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lakehouse.refresh_silver(spark, lake, dims)
    whole = lakehouse.resolve_late(spark, lake, dims)
    settled = whole._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")[0]
    assert "Join" not in settled and "Aggregate" not in settled
    assert whole.filter(late.unresolved() if "_hotel" in whole.columns else F.lit(True)).count() == 30
