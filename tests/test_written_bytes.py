"""What a build shuffles and writes follows the bookings, not the names of their columns."""

import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.catalog import queries
from roomledger.operators import loads, numbering
from roomledger.plans import feed, lakehouse
from roomledger.session import work_folder

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def lake(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


def raw(spark, rows):
    """Bookings of three years; l_key tells them apart."""
    values = {
        "hotel": F.lit("City Hotel"), "arrival_date_year": (2015 + F.col("id") % 3).cast("int"),
        "arrival_date_month": F.lit("July"), "arrival_date_day_of_month": (1 + F.col("id") % 28).cast("int"),
        "adr": (F.col("id") % 977 - 5).cast("double"), "stays_in_week_nights": F.lit(2), "stays_in_weekend_nights": F.lit(1),
    }
    columns = [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in schemas.RAW_BOOKING.items()]
    return spark.range(0, rows, 1, 4).select(*columns, F.col("id").alias("l_key"))


def size(folder, pattern):
    return sum(p.stat().st_size for p in Path(folder).rglob(pattern))


def test_landed_files_are_compressed_and_stream_into_bronze(spark, lake):
    lakehouse.land_feed(raw(spark, 20_000), lake, ("l_key",), unique=True)
    assert size(lake.intervals, "part-*") < 20_000 * 60
    rows = lakehouse.load_bronze(spark, lake)
    assert rows.agg(F.count("*"), F.count_distinct("booking_id"), F.max("booking_id")).first()[:] == (20_000,) * 3
    assert {r[0] for r in rows.select("_source_file").distinct().collect()} == {f"fact_stream_{y}.json" for y in (2015, 2016, 2017)}


def test_neither_digests_nor_measures_are_stored_while_numbering(spark, lake):
    lakehouse.land_feed(raw(spark, 50), lake, ("l_key",), unique=True)
    copies = {p.parent.name: p.parent for p in Path(f"{lake.base}/staging").rglob("_SUCCESS")}
    assert set(spark.read.parquet(str(copies["raw"])).columns) == {*schemas.RAW_BOOKING, "l_key"}
    kept = set(spark.read.parquet(str(copies["sorted"])).columns)
    assert not kept & {"_first_half", "_second_half", "total_revenue", "total_guests", "date_key", "arrival_date_month"}


def test_measures_after_numbering_are_those_before(spark):
    bookings = raw(spark, 300).withColumn("stays_in_week_nights", F.when(F.col("l_key") % 4 > 0, F.lit(2)))
    folder = work_folder(spark, "test")
    after = feed.booking_feed(bookings, f"{folder}/after", ["adr", "l_key"], unique=True)
    before = feed.as_feed(feed.numbered(feed.with_measures(bookings), f"{folder}/before", ["adr", "l_key"], unique=True))
    assert sorted(map(repr, after.collect())) == sorted(map(repr, before.collect()))


def test_partitions_follow_the_rows(spark):
    assert numbering.partitions_for(spark, 10) is None
    assert numbering.partitions_for(spark, 9 * numbering.ROWS_PER_TASK + 1) == 10


def test_the_setting_for_open_files_is_restored(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), loads.open_files(spark):
        assert spark.conf.get(name) == str(loads.OPEN_FILES)
        raise ValueError
    assert spark.conf.get(name) == before


def test_of_a_corrected_source_only_digests_that_differ_are_stored(spark, lake):
    first = raw(spark, 3_000)
    second = first.filter("l_key != 7").withColumn("babies", F.when(F.col("l_key") == 3, 1).cast("int"))
    lakehouse.land_feed(first, lake, ("l_key",), unique=True, source="web")
    assert not list(Path(f"{lake.base}/staging").rglob("compared"))
    lakehouse.land_feed(second, lake, ("l_key",), unique=True, source="web")
    compared = [str(p) for p in Path(f"{lake.base}/staging").rglob("compared")]
    assert len(compared) == 1
    stored = spark.read.parquet(*compared)
    assert stored.columns == ["_first_half", "_second_half", "_here", "_there"] and stored.count() == 3
    lakehouse.load_bronze(spark, lake)
    standing = lakehouse.standing_bronze(spark, lake)
    assert standing.count() == 2_999 and standing.filter("babies = 1").count() == 1


def test_a_corrected_source_keeps_copies(spark, lake):
    rows = raw(spark, 40).drop("l_key")
    lakehouse.land_feed(rows.unionByName(rows), lake, source="web")
    lakehouse.land_feed(rows.unionByName(rows).unionByName(rows.limit(5)), lake, source="web")
    assert lakehouse.load_bronze(spark, lake).count() == 85
    assert lakehouse.standing_bronze(spark, lake).count() == 85
    lakehouse.land_feed(rows, lake, source="web")
    assert lakehouse.load_bronze(spark, lake).count() == 85
    assert lakehouse.standing_bronze(spark, lake).count() == 40


def test_columns_that_only_order_are_not_stored_by_the_numbering(spark, lake):
    lakehouse.land_feed(raw(spark, 50), lake, ("l_key",), unique=True)
    copies = {p.parent.name: p.parent for p in Path(f"{lake.base}/staging").rglob("_SUCCESS")}
    assert set(spark.read.parquet(str(copies["sorted"])).columns) <= {*schemas.FEED, "_place", "_part"}


def test_queries_number_no_wider_rows_than_they_return(spark, monkeypatch):
    folder = work_folder(spark, "test")
    monkeypatch.setattr(queries, "work_folder", lambda _, label: f"{folder}/{label}")
    assert "l_orderkey" not in queries.booking_feed(spark, SF_DIR).columns
    stored = set(spark.read.parquet(f"{folder}/feed/sorted").columns)
    assert stored <= {*schemas.FEED, "_place", "_part"}
    shuffled = queries.sample.bookings(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = shuffled.split("Join Inner, (l_orderkey")[1].split("Relation")[0]
    assert "to_date" in lines or "cast(l_shipdate" in lines


@pytest.fixture
def given(spark):
    """Order tables with keys that are NULL, repeated or lead nowhere, and orders without a date."""
    folder = work_folder(spark, "given")
    tables = {
        "nation": "id as n_nationkey, concat('NATION_', id) as n_name",
        "customer": "if(id = 7, null, id) as c_custkey, id % 25 as c_nationkey, id * 1.5 - 20 as c_acctbal, if(id % 9 > 0, 'AUTO', null) as c_mktsegment",
        "part": "if(id = 3, 4, id) as p_partkey, concat('TYPE ', id % 6) as p_type, 'Brand#1' as p_brand, int(id % 50) as p_size",
        "orders": "if(id = 5, 6, id) as o_orderkey, id % 45 as o_custkey, if(id % 11 > 0, date_add(date'1997-06-01', int(id * 7)), null) as o_orderdate, '1-URGENT' as o_orderpriority, 'F' as o_orderstatus",
        "lineitem": "if(id = 9, null, id % 70) as l_orderkey, int(id % 7) as l_linenumber, if(id % 13 > 0, id % 50, null) as l_partkey, id % 10 as l_suppkey, id * 2.5 as l_extendedprice, double(id % 20) as l_quantity, date_add(date'1997-07-01', int(id)) as l_shipdate, if(id % 3 = 0, 'R', 'N') as l_returnflag, if(id % 2 = 0, 'O', 'F') as l_linestatus",
    }
    for (name, columns), rows in zip(tables.items(), (25, 40, 45, 65, 300)):
        spark.range(rows).createOrReplaceTempView("given_ids")
        spark.sql(f"SELECT {columns} FROM given_ids").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_what_is_landed_in_two_loads_is_joined_once(spark, given):
    folder = work_folder(spark, "test")
    bookings = queries._staged_bookings(spark, given, folder)
    for part in (bookings.filter("arrival_date_year < 1998"), bookings.filter("arrival_date_year >= 1998")):
        assert part.inputFiles() and all(folder in file for file in part.inputFiles())
    dated = feed.with_measures(queries.sample.bookings(spark, given))
    keyed = feed.as_feed(dated.withColumn("booking_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")))
    assert bookings.dtypes == keyed.dtypes
    assert sorted(map(repr, bookings.collect())) == sorted(map(repr, keyed.collect()))


def test_streamed_tables_and_snapshots_are_compressed_alike(spark, lake):
    loads.write_intervals(feed.booking_feed(raw(spark, 50), work_folder(spark, "test"), ["l_key"]), lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lake.store(spark.range(5), "dim_hotel")
    for path in (lake.path(lakehouse.BRONZE), lake.path("dim_hotel")):
        names = [p.name for p in Path(path).rglob("part-*")]
        assert names and all(name.endswith(".zstd.parquet") for name in names)


def test_parts_too_many_to_broadcast_are_joined_to_narrow_lines(spark, given, monkeypatch):
    few = queries.sample.bookings(spark, given)
    monkeypatch.setattr(queries.sample, "MOST_PARTS", 0)
    many = queries.sample.bookings(spark, given)
    assert few.count() > 100 and many.dtypes == few.dtypes and sorted(map(repr, many.collect())) == sorted(map(repr, few.collect()))
    outer = [frame._jdf.queryExecution().optimizedPlan().toString().split("Join Inner, ")[1] for frame in (few, many)]
    assert [plan.split("#")[0] for plan in outer] == ["(l_partkey", "(l_orderkey"]
