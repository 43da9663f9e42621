"""Feeds known by their contents, corrected feeds, and tables that are replaced as snapshots."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.operators import keys, loads
from roomledger.operators.snapshots import Snapshots, show_as
from roomledger.plans import dims, lakehouse, landing
from roomledger.session import work_folder


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def lake(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


def raw(spark, *bookings, columns=None):
    """Bookings given as {column: value}; the rest is fixed or NULL."""
    fixed = {"hotel": "City Hotel", "arrival_date_year": 2015, "arrival_date_month": "July",
             "arrival_date_day_of_month": 1, "adr": 10.0, "stays_in_week_nights": 1, "stays_in_weekend_nights": 0}
    rows = [tuple({**fixed, **b}.get(name) for name in schemas.RAW_BOOKING) for b in bookings]
    frame = spark.createDataFrame(rows, schemas.ddl(schemas.RAW_BOOKING))
    return frame.select(*(columns or frame.columns))


def landed(spark, lake):
    return lakehouse.load_bronze(spark, lake)


def test_nulls_and_column_order_do_not_fool_the_identity(spark, lake):
    first = raw(spark, *[{"adults": 2, "children": None, "lead_time": k} for k in range(3)])
    corrected = raw(spark, *[{"adults": None, "children": 2, "lead_time": k} for k in range(3)])
    turned = first.select(*reversed(first.columns)).repartition(3)
    lakehouse.land_feed(first, lake)
    assert landed(spark, lake).count() == 3
    lakehouse.land_feed(turned, lake)
    assert landed(spark, lake).count() == 3
    lakehouse.land_feed(corrected, lake)
    lakehouse.land_feed(corrected.select(*reversed(corrected.columns)), lake)
    rows = landed(spark, lake)
    assert rows.count() == 6 and rows.filter("adults IS NULL AND children = 2").count() == 3


def test_a_name_stands_for_the_rows_and_their_number(spark, fresh_folder):
    names = [
        landing.staged(frame, f"{fresh_folder}/{k}")[1]
        for k, frame in enumerate([
            raw(spark, {"adults": 1}), raw(spark, {"adults": 1}, {"adults": 1}), raw(spark, {"children": 1}),
            raw(spark), raw(spark, {"adults": None}), raw(spark, {"meal": ""}), raw(spark, {"meal": None, "adults": 0}),
            raw(spark, {"adults": 1}).withColumn("adults", F.col("adults").cast("bigint")),
        ])
    ]
    assert names[-1] == names[0] and len(set(names[:-1])) == len(names) - 1


@pytest.fixture
def fresh_folder(spark):
    return work_folder(spark, "test")


def test_of_a_corrected_source_only_the_changes_land(spark, lake):
    first = [{"lead_time": k, "adults": 2} for k in range(10)] + [{"lead_time": 50}] * 4
    lakehouse.land_feed(raw(spark, *first), lake, source="web")
    assert landed(spark, lake).count() == 14
    # Row 3 corrected, row 4 gone, one copy less of the four, two rows added of which one is a copy.
    second = [b for b in first[:10] if b["lead_time"] not in (3, 4)] + [{"lead_time": 50}] * 3
    second += [{"lead_time": 3, "adults": 9}, {"lead_time": 60}, {"lead_time": 0, "adults": 2}]
    for _ in range(2):
        lakehouse.land_feed(raw(spark, *reversed(second)), lake, source="web")
    rows = landed(spark, lake)
    assert rows.count() == 14 + 3
    assert sorted(r.lead_time for r in rows.filter("booking_id > 14").collect()) == [0, 3, 60]
    standing = lakehouse.standing_bronze(spark, lake)
    wanted = sorted((b["lead_time"], b.get("adults")) for b in second)
    assert sorted(((r.lead_time, r.adults) for r in standing.collect()), key=repr) == sorted(wanted, key=repr)
    # Another source with the same rows is more bookings; going back to the first version is a change again.
    lakehouse.land_feed(raw(spark, *first[:2]), lake, source="phone")
    lakehouse.land_feed(raw(spark, *first), lake, source="web")
    landed(spark, lake)
    assert lakehouse.standing_bronze(spark, lake).count() == 14 + 2
    ids = landed(spark, lake).agg(F.count("*"), F.count_distinct("booking_id"), F.max("booking_id")).first()
    assert len(set(ids)) == 1


def test_a_correction_cut_short_goes_on(spark, lake):
    first = raw(spark, *[{"lead_time": k} for k in range(6)])
    second = raw(spark, *[{"lead_time": k * 2} for k in range(6)])
    lakehouse.land_feed(first, lake, source="web")
    lakehouse.land_feed(second, lake, source="web")
    landed(spark, lake)
    before = table(lakehouse.standing_bronze(spark, lake).select("booking_id", "lead_time"))
    for file in Path(lake.manifest).glob("part-*"):
        if '"done":true' in file.read_text() and "-v1" in file.read_text():
            file.unlink()
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="in part"):
        lakehouse.land_feed(first, lake, source="web")
    lakehouse.land_feed(second, lake, source="web")
    landed(spark, lake)
    assert table(lakehouse.standing_bronze(spark, lake).select("booking_id", "lead_time")) == before
    assert [r[1] for r in before] == [0, 2, 4, 6, 8, 10]


def test_the_source_is_read_once(spark, lake):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    source = raw(spark, *[{"lead_time": k} for k in range(9)])
    lakehouse.land_feed(source.mapInPandas(count, source.schema), lake)
    assert read.value == 9 and landed(spark, lake).count() == 9


# Snapshots.

def test_a_failed_write_leaves_the_table(spark, fresh_folder):
    tables = Snapshots(fresh_folder)
    assert tables.newest(spark) == {}
    first = tables.replace(spark.range(5).toDF("x"), "numbers")
    failing = spark.range(0, 100, 1, 4).selectExpr("if(id = 90, raise_error('half way'), id) as x")
    with pytest.raises(Exception, match="half way"):
        tables.replace(failing, "numbers")
    assert tables.newest(spark) == {"numbers": first} and spark.read.parquet(first).count() == 5


def test_a_reader_keeps_its_version_across_a_switch(spark, lake):
    lake.store(spark.range(5).toDF("x"), "gold_top_countries_revenue")
    by_name = spark.table(lake.table("gold_top_countries_revenue"))
    assert by_name.count() == 5
    lake.store(by_name.selectExpr("x + 10 as x").unionAll(by_name), "gold_top_countries_revenue")
    assert by_name.count() == 5
    assert spark.table(lake.table("gold_top_countries_revenue")).count() == 10
    lake.store(spark.range(3).selectExpr("id as x", "'new' as y"), "gold_top_countries_revenue")
    assert spark.table(lake.table("gold_top_countries_revenue")).columns == ["x", "y"]
    old = lake.snapshots.versions(spark, "gold_top_countries_revenue")
    assert [spark.read.parquet(p).count() for p in old] == [5, 10, 3]
    assert lake.path("gold_top_countries_revenue") == old[-1]


def test_names_stay_whole_when_gold_fails(spark, lake, monkeypatch):
    for name in lakehouse.GOLD:
        lake.store(spark.range(4).toDF("x"), name)
    names = list(lakehouse.GOLD)
    broken = spark.range(9).selectExpr("if(id = 8, raise_error('lost'), id) as x")
    monkeypatch.setitem(lakehouse.GOLD, names[0], lambda silver: spark.range(7).toDF("x"))
    monkeypatch.setitem(lakehouse.GOLD, names[1], lambda silver: broken)
    with pytest.raises(Exception, match="lost"):
        lakehouse.load_gold(None, lake)
    assert [spark.table(lake.table(name)).count() for name in names] == [7, 4, 4]


def test_a_table_of_the_same_name_becomes_a_view(spark, lake, fresh_folder):
    spark.range(2).write.parquet(f"{fresh_folder}/a")
    spark.range(3).write.parquet(f"{fresh_folder}/b")
    name = lake.table("gold_x")
    loads.register(spark, name, f"{fresh_folder}/a")
    assert show_as(spark, name, f"{fresh_folder}/b").count() == 3
    assert spark.read.parquet(f"{fresh_folder}/a").count() == 2


# Keys.

def countries(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "country_code string")


def test_keys_are_given_once(spark, fresh_folder):
    path = f"{fresh_folder}/registry"

    def load(*codes):
        found = keys.registered(countries(spark, *codes), "country_code", "k", path, f"{fresh_folder}/{uuid.uuid4().hex}")
        return {r.country_code: r.k for r in found.collect()}

    assert load() == {}
    assert load("PRT", "ESP", "PRT", None) == {"ESP": 1, "PRT": 2}
    assert load("PRT", "DEU", "FRA", "ESP") == {"ESP": 1, "PRT": 2, "DEU": 3, "FRA": 4}
    assert load("AUT") == {"ESP": 1, "PRT": 2, "DEU": 3, "FRA": 4, "AUT": 5}


def test_keys_given_twice_are_found(spark, fresh_folder):
    path = f"{fresh_folder}/registry"
    for code in ("A", "B"):
        spark.createDataFrame([(1, code)], "k bigint, country_code string").write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="two loads"):
        keys.registered(countries(spark, "C"), "country_code", "k", path, f"{fresh_folder}/x")


def profiles(spark, *codes):
    rows = [(c, 1, "Online") for c in codes]
    return spark.createDataFrame(rows, "country string, previous_cancellations int, market_segment string")


def test_a_new_country_moves_no_key(spark, fresh_folder):
    def load(*codes):
        found = dims.lasting_guest_origins(
            profiles(spark, *codes), f"{fresh_folder}/registry", f"{fresh_folder}/{uuid.uuid4().hex}"
        )
        return {r.country_code: (r.guest_origin_key, r.total_bookings) for r in found.collect()}

    first = dims.guest_origins(profiles(spark, "ESP", "PRT", "PRT"), f"{fresh_folder}/plain")
    assert load("ESP", "PRT", "PRT") == {r.country_code: (r.guest_origin_key, r.total_bookings) for r in first.collect()}
    assert load("DEU", "PRT") == {"ESP": (1, 0), "PRT": (2, 1), "DEU": (3, 1)}
