import datetime as dt

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.functions import dates, measures, names
from roomledger.plans import dims, feed
from roomledger.sources import files, jdbc


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def raw(**changes):
    row = {
        "hotel": "City Hotel",
        "is_canceled": 0,
        "lead_time": 10,
        "arrival_date_year": 2015,
        "arrival_date_month": "July",
        "arrival_date_day_of_month": 1,
        "stays_in_weekend_nights": 1,
        "stays_in_week_nights": 1,
        "adults": 2,
        "children": 0,
        "babies": 0,
        "meal": "BB",
        "country": "PRT",
        "market_segment": "Direct",
        "distribution_channel": "Direct",
        "is_repeated_guest": 0,
        "reserved_room_type": "A",
        "deposit_type": "No Deposit",
        "customer_type": "Transient",
        "adr": 50.0,
        "total_of_special_requests": 0,
        "reservation_status": "Check-Out",
    }
    assert set(changes) <= set(row)
    return tuple({**row, **changes}.values())


def measured(spark, *rows):
    return feed.with_measures(files.rows(spark, list(rows), schemas.RAW_BOOKING))


def test_every_month_has_its_number(spark):
    rows = measured(spark, *[raw(arrival_date_month=month) for month in dates.MONTHS])
    assert [r.arrival_date.month for r in rows.collect()] == list(range(1, 13))


@pytest.mark.parametrize(
    ("year", "month", "day", "expected"),
    [
        (2015, "July", 1, dt.date(2015, 7, 1)),
        (2016, "February", 29, dt.date(2016, 2, 29)),
        (2015, "July", 31, dt.date(2015, 7, 31)),
        (2015, "February", 29, None),
        (2015, "April", 31, None),
        (2015, "Julember", 1, None),
        (2015, "july", 1, None),
        (2015, None, 1, None),
        (None, "July", 1, None),
        (2015, "July", None, None),
        (2015, "July", 0, None),
        (2015, "July", 32, None),
    ],
)
def test_arrival_date(spark, year, month, day, expected):
    changes = {
        "arrival_date_year": year,
        "arrival_date_month": month,
        "arrival_date_day_of_month": day,
    }
    row = measured(spark, raw(**changes)).first()
    assert row.arrival_date == expected
    key = int(expected.strftime("%Y%m%d")) if expected else None
    assert row.date_key == key


def test_every_day_that_exists_and_no_other(spark):
    years = spark.range(2015, 2017).select(F.col("id").cast("int").alias("y"))
    months = years.select("y", F.explode(F.sequence(F.lit(0), F.lit(13))).alias("m"))
    parts = months.select("y", "m", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("d"))
    date = dates.date_from_parts(F.col("y"), F.col("m"), F.col("d"))
    for y, m, d, found in parts.select("y", "m", "d", date).collect():
        try:
            assert found == dt.date(y, m, d)
        except ValueError:
            assert found is None


@pytest.mark.parametrize(
    ("adr", "revenue", "cleaned"),
    [(-5.0, 0.0, 0.0), (None, None, None), (0.0, 0.0, 0.0), (62.565, 125.13, 62.565)],
)
def test_rate_and_revenue(spark, adr, revenue, cleaned):
    row = measured(spark, raw(adr=adr)).first()
    assert (row.total_revenue, row.adr) == (revenue, cleaned)


def test_missing_guest_count_makes_the_total_missing(spark):
    row = measured(spark, raw(children=None)).first()
    assert row.total_guests is None
    assert row.total_nights == 2


def test_calendar_covers_every_day(spark):
    calendar = dims.calendar(spark, dt.date(2015, 7, 1), dt.date(2017, 8, 31))
    rows = {r.full_date: r for r in calendar.frame.collect()}
    assert calendar.rows == len(rows) == 793
    assert calendar.frame.columns == [
        "date_key",
        "full_date",
        "day_of_month",
        "month_number",
        "month_name",
        "quarter",
        "year",
        "day_of_week",
        "day_name",
        "is_weekend",
    ]
    for day, row in rows.items():
        assert row.date_key == int(day.strftime("%Y%m%d"))
        assert (row.day_of_month, row.month_number, row.year) == (day.day, day.month, day.year)
        assert row.month_name == day.strftime("%B")
        assert row.day_name == day.strftime("%A")
        assert row.day_of_week == day.weekday()
        assert row.is_weekend == (1 if day.weekday() > 4 else 0)
        assert row.quarter == (day.month + 2) // 3
    assert {dt.date(2016, 2, 29), dt.date(2015, 7, 31)} <= set(rows)
    assert rows[dt.date(2015, 7, 5)].day_of_week == 6


def test_rounding_rules(spark):
    half_even = measures.share_half_even(F.lit(1.0), F.lit(20000.0))
    assert one(spark, F.round(F.lit(0.125), 2), half_even) == (0.13, 0.0)
    up = measures.share_half_even(F.lit(3.0), F.lit(20000.0))
    assert one(spark, up) == (0.0002,)


def test_ratio_of_nothing_is_null(spark):
    nothing = F.lit(0)
    assert one(spark, measures.percent(nothing, nothing), measures.ratio(nothing, nothing)) == (
        None,
        None,
    )


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("file:/x/fact_stream_2015.json", "fact_stream_2015.json"),
        ("file:/x/fact_stream_2016.json/part-0.json", "fact_stream_2016.json"),
        ("file:/x/interval_year=2017/part-0.json", "fact_stream_2017.json"),
        ("file:/x/interval_year=__HIVE_DEFAULT_PARTITION__/part-0.json", ""),
        ("file:/x/other.json", ""),
    ],
)
def test_source_file(spark, path, expected):
    assert one(spark, names.source_file(F.lit(path))) == (expected,)


@pytest.mark.parametrize(
    ("name", "layer"),
    [
        ("dim_date", "DIM"),
        ("bronze_fact_bookings", "BRONZE"),
        ("silver_fact_bookings_enriched", "SILVER"),
        ("gold_top_countries_revenue", "GOLD"),
        ("bronze_dim", "DIM"),
    ],
)
def test_table_layer(spark, name, layer):
    assert one(spark, names.table_layer(F.lit(name))) == (layer,)


@pytest.mark.parametrize(
    ("name", "kind"),
    [("Resort Hotel", "Resort"), ("City Hotel", "City"), ("resort", "City")],
)
def test_hotel_type(spark, name, kind):
    assert one(spark, names.hotel_type(F.lit(name))) == (kind,)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    """Other columns, another order, and text that is no number."""
    columns = list(reversed(schemas.RAW_BOOKING))
    values = dict(zip(schemas.RAW_BOOKING, raw(children=7, country=None)))
    values["children"] = "NA"
    for copy in range(2):
        lines = ["extra," + ",".join(columns)]
        cells = ["" if values[c] is None else str(values[c]) for c in columns]
        lines.append(f"{copy}," + ",".join(cells))
        (tmp_path / f"part{copy}.csv").write_text("\n".join(lines) + "\n")
    df = files.read_bookings_csv(spark, str(tmp_path))
    assert [(c, t) for c, t in df.dtypes] == list(schemas.RAW_BOOKING.items())
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0].children is None and rows[0].country is None
    assert (rows[0].adr, rows[0].adults, rows[0].arrival_date_month) == (50.0, 2, "July")
    assert feed.with_measures(df).first().total_guests is None


def test_reference_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("hotel_id,hotel_name\n1,Resort Hotel\n2,City Hotel\n")
    (tmp_path / "b.csv").write_text(
        "room_type_id,room_code,room_name,base_rate_tier\n1,A,Standard Room,Standard\n"
    )
    hotels = dims.hotels(files.read_hotels_csv(spark, str(tmp_path / "a.csv")))
    assert [tuple(r) for r in hotels.orderBy("hotel_key").collect()] == [
        (1, "Resort Hotel", "Resort"),
        (2, "City Hotel", "City"),
    ]
    rooms = dims.room_types(files.read_room_types_csv(spark, str(tmp_path / "b.csv")))
    assert [tuple(r) for r in rooms.collect()] == [(1, "A", "Standard Room", "Standard")]
    assert rooms.columns[0] == "room_type_key"


def test_documents_lose_their_id_and_mistyped_fields(spark, tmp_path):
    (tmp_path / "profiles.json").write_text(
        '{"_id": "a", "country": "PRT", "previous_cancellations": 1, "age": 30}\n'
        '{"_id": "b", "country": "PRT", "previous_cancellations": "1"}\n'
        '{"_id": "c", "country": "PRT", "previous_cancellations": 2.0}\n'
    )
    profiles = files.read_documents(spark, str(tmp_path))
    assert profiles.columns == ["country", "previous_cancellations", "market_segment"]
    assert files.count_documents(profiles) == 3
    assert sorted(r.previous_cancellations or 0 for r in profiles.collect()) == [0, 0, 1]


def test_jdbc_options():
    base = jdbc.jdbc_options("jdbc:x:y", "hotels", "a.Driver", fetchsize="10000")
    assert base == {
        "url": "jdbc:x:y",
        "dbtable": "hotels",
        "driver": "a.Driver",
        "fetchsize": "10000",
    }
    split = jdbc.Split("hotel_id", 1, 1_000_000, 64)
    assert jdbc.jdbc_options("u", "t", "d", split) == {
        "url": "u",
        "dbtable": "t",
        "driver": "d",
        "partitionColumn": "hotel_id",
        "lowerBound": "1",
        "upperBound": "1000000",
        "numPartitions": "64",
    }


def test_schema_listing(spark):
    source = files.rows(spark, [(1, "x")], schemas.HOTELS)
    target = dims.hotels(source)
    assert schemas.describe(target) == list(schemas.DIM_HOTEL.items())
    assert schemas.column_mapping(source, target) == {
        "source_columns": 2,
        "target_columns": 3,
        "added": ["hotel_key", "hotel_type"],
        "dropped": ["hotel_id"],
    }


def test_dates_of_all_days_and_odd_parts(spark):
    years, days = (None, -1, 0, 1, 1900, 2000, 2023, 9999, 10000, 2**31 - 1), (None, -5, 0, 1, 28, 29, 30, 31, 32)
    rows = [(y, m, d) for y in years for m in (None, 0, 1, 2, 4, 12, 13) for d in days]
    df = spark.createDataFrame(rows, "y int, m int, d int")
    parts = [F.col(c) for c in "ymd"]
    checked = F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    found = df.select(dates.date_from_parts(*parts).eqNullSafe(checked).alias("same"))
    assert found.filter("same").count() == len(rows)
