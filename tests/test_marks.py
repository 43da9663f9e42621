"""Rows found by a bit per number, and versions of a feed compared without moving whole rows."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.operators import codes, loads, marks
from roomledger.plans import feed, lakehouse, landing
from roomledger.session import work_folder

NUMBERS = [0, 1, 7, 8, 32_767, 32_768, 65_535, 65_536, (5 << 33) + 9, (5 << 33) + 40_000, None, 7]


@pytest.fixture
def folder(spark):
    return work_folder(spark, "test")


@pytest.mark.parametrize("most", [marks.MOST_BLOCKS, 1])
def test_rows_are_found_by_their_numbers(spark, folder, monkeypatch, most):
    monkeypatch.setattr(marks, "MOST_BLOCKS", most)
    rows = spark.createDataFrame([(k, str(k)) for k in NUMBERS + [6, 9, 32_769, 5 << 33]], "n bigint, text string")
    wanted = spark.createDataFrame([(k,) for k in NUMBERS[:11:2] + [None, 7, 7, 123]], "n bigint")
    found = marks.among(rows, "n", wanted, f"{folder}/in")
    others = marks.among(rows, "n", wanted, f"{folder}/out", without=True)
    chosen = {r.n for r in wanted.collect() if r.n is not None}
    assert found.columns == others.columns == rows.columns
    assert sorted(found.collect()) == sorted(r for r in rows.collect() if r.n in chosen)
    assert sorted(others.collect(), key=repr) == sorted((r for r in rows.collect() if r.n not in chosen), key=repr)


def test_no_number_is_wanted(spark, folder):
    rows = spark.range(5).toDF("n")
    assert marks.among(rows, "n", rows.limit(0), f"{folder}/in").count() == 0
    assert marks.among(rows, "n", rows.limit(0), f"{folder}/out", without=True).count() == 5


def bookings(spark, rows):
    """Bookings of three years; l_key tells them apart."""
    values = {
        "hotel": F.lit("City Hotel"), "arrival_date_year": (2015 + F.col("id") % 3).cast("int"),
        "arrival_date_month": F.lit("July"), "arrival_date_day_of_month": (1 + F.col("id") % 28).cast("int"),
        "adr": (F.col("id") % 977 - 5).cast("double"), "babies": F.lit(0), "adults": (F.col("id") % 3).cast("int"),
        "country": F.when(F.col("id") % 7 > 0, F.concat(F.lit("C"), F.col("id") % 9)),
    }
    columns = [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in schemas.RAW_BOOKING.items()]
    return spark.range(0, rows, 1, 4).select(*columns, F.col("id").alias("l_key"))


@pytest.fixture
def lake(spark, folder):
    lake = lakehouse.Lakehouse(folder, "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


def test_new_rows_and_gone_ids_shuffle_no_whole_rows(spark, folder):
    first, second = bookings(spark, 900), bookings(spark, 900).filter("l_key != 7").withColumn("babies", (F.col("l_key") % 5).cast("int"))
    known = first.select(F.col("l_key").alias("booking_id"), *[c.alias(n) for n, c in landing.row_digest(first).items()])
    rows = landing.copied(second, f"{folder}/raw")
    new, gone = landing.changes(rows.withColumns(landing.row_digest(second)), known, f"{folder}/changes")
    assert sorted(r.booking_id for r in gone.collect()) == sorted({7, *(k for k in range(900) if k % 5)})
    assert sorted(r.l_key for r in new.collect()) == [k for k in range(900) if k % 5 and k != 7]
    for frame in (new, gone):
        assert "Exchange hashpartitioning" not in frame._jdf.queryExecution().executedPlan().toString()


def test_coded_columns_come_back(spark):
    rows = spark.createDataFrame(
        [("a", None, -5, 2**40, 1.5, ""), (None, None, None, 7, None, "é\u0001"), ("", None, 2**20, -3, 0.0, "a"), ("b,", None, 0, None, 2.0, None)],
        "text string, none string, number int, wide bigint, rate double, other string",
    ).withColumn("nothing", F.lit(None).cast("int")).withColumn("small", F.lit(3).cast("smallint"))
    packed, values = codes.coded(rows, rows.columns)
    assert set(values) == {"text", "number", "other", "small"} and len(packed) == 1
    rest = [c for c in rows.columns if c not in values]
    back = rows.select(*rest, *packed).select(*[values.get(c, F.col(c)) for c in rows.columns])
    assert back.dtypes == rows.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_many_values_take_several_words_or_none(spark):
    numbers = {f"n{k}": (F.col("id") * (k + 3) % 99_991 - 500).cast("int") for k in range(9)}
    rows = spark.range(2_000).select("id", *[c.alias(n) for n, c in numbers.items()], F.concat(F.lit("t"), "id").alias("text"))
    packed, values = codes.coded(rows, rows.columns)
    assert "text" not in values and set(values) == {"id", *numbers} and len(packed) > 2
    back = rows.select("text", *packed).select(*[values.get(c, F.col(c)) for c in rows.columns])
    assert sorted(back.collect()) == sorted(rows.collect())
    assert codes.coded(rows, ["text"]) == ([], {}) and codes.coded(rows, []) == ([], {})
    assert codes.coded(rows.limit(0), rows.columns)[1] == {}


def test_a_stored_feed_is_not_copied_and_shuffled_as_bits(spark, lake, monkeypatch):
    shuffled = []
    number = feed.number_rows
    monkeypatch.setattr(feed, "number_rows", lambda df, *a, **kw: shuffled.append(set(df.columns)) or number(df, *a, **kw))
    first = landing.copied(bookings(spark, 300), lake.staging("bookings"))
    second = first.filter("l_key != 7").withColumn("babies", F.when(F.col("l_key") % 5 == 3, 1).otherwise(F.col("babies")))
    for version in (first, second, second):
        lakehouse.land_feed(version, lake, ("l_key",), unique=True, source="web", stored=True)
    assert not list(Path(lake.base).glob("staging/feed-*/raw"))
    assert len(shuffled) == 2 and not any({"country", "adults", "arrival_date_month", "_place"} & names for names in shuffled)
    lakehouse.load_bronze(spark, lake)
    rows = lakehouse.standing_bronze(spark, lake)
    assert rows.count() == 299 and rows.agg(F.sum("babies")).first()[0] == 60
    wanted = second.groupBy("country", "adults", "babies").count().collect()
    assert sorted(rows.groupBy("country", "adults", "babies").count().collect(), key=repr) == sorted(wanted, key=repr)


def test_a_stored_feed_with_copies_lands_as_an_unstored_one(spark, lake):
    rows = bookings(spark, 30).drop("l_key")
    stored = landing.copied(rows.unionByName(rows), lake.staging("bookings"))
    lakehouse.land_feed(stored, lake, source="web", stored=True)
    lakehouse.land_feed(rows.unionByName(rows), lake, source="web")
    assert lakehouse.load_bronze(spark, lake).count() == 60
    lakehouse.land_feed(rows.unionByName(rows).unionByName(rows), lake, source="web")
    assert lakehouse.load_bronze(spark, lake).count() == 90
    lakehouse.land_feed(landing.copied(rows, lake.staging("bookings")), lake, source="web", stored=True)
    lakehouse.load_bronze(spark, lake)
    assert lakehouse.standing_bronze(spark, lake).count() == 30
