"""The registered queries. Each takes (spark, sf_dir) and reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.catalog import sample
from roomledger.functions import names
from roomledger.operators import checks, loads, merge
from roomledger.operators.lookup import Dimension
from roomledger.plans import dims, feed, gold, gold_state, reports, silver
from roomledger.plans.lakehouse import (
    SILVER,
    Lakehouse,
    build,
    land_feed,
    load_bronze,
    load_bronze_by_interval,
    load_dimensions,
    refresh_gold_state,
    refresh_silver,
    resolve_late,
    standing_bronze,
    streamed_silver,
)
from roomledger.plans.landing import copied
from roomledger.session import work_folder
from roomledger.sources import files

Query = Callable[[SparkSession, str], DataFrame]


# Shared inputs.

def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.with_measures(sample.bookings(spark, sf_dir))


def _numbered(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Numbered bookings with the columns to keep: those of the feed, unless given."""
    folder = work_folder(spark, "feed")
    dated = feed.with_arrival(sample.bookings(spark, sf_dir))
    lines = sample.given(spark, sf_dir, "lineitem").count()
    kept = feed.feed_sources(dated) if keep is None else keep
    return feed.numbered(
        dated, folder, sample.TIE_BREAKERS, unique=True, rows=lines, keep=kept, codec="lz4_raw"
    )


def _calendar(spark: SparkSession, sf_dir: str) -> Dimension:
    first, last = dims.date_bounds(sample.given(spark, sf_dir, "orders"), "o_orderdate")
    return dims.calendar(spark, first, last)


def _dimensions(spark: SparkSession, sf_dir: str) -> silver.Dimensions:
    """The guest origins are numbered through stored files, so counting them is cheap."""
    origins = dims.guest_origins(
        sample.guest_profiles(spark, sf_dir), work_folder(spark, "origins")
    )
    return silver.Dimensions(
        date=_calendar(spark, sf_dir),
        hotel=Dimension(dims.hotels(sample.hotels(spark)), len(sample.HOTEL_ROWS)),
        guest_origin=Dimension.counted(origins),
        room_type=Dimension(dims.room_types(sample.room_types(spark)), len(sample.ROOM_TYPE_ROWS)),
    )


def _as_bronze(bookings: DataFrame) -> DataFrame:
    """Bookings with the lineage columns that the stream would give them."""
    return feed.as_feed(bookings).select(
        "*",
        F.current_timestamp().alias("_ingest_timestamp"),
        names.feed_file(F.col("arrival_date_year")).alias("_source_file"),
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as one plan from the given tables, for aggregates.

    These count ids but never read them, so the source's own key stands for
    booking_id and the sort behind the numbering is not paid for.
    """
    keyed = _dated(spark, sf_dir).withColumn("booking_id", F.col("l_orderkey"))
    return silver.enrich(_as_bronze(keyed), _dimensions(spark, sf_dir))


def _lake(spark: SparkSession) -> Lakehouse:
    base = work_folder(spark, "lake")
    return Lakehouse(base, "lake_" + base.rsplit("-", 1)[1])


def _built(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, DataFrame]:
    lake = _lake(spark)
    registry = build(
        spark,
        lake,
        raw=sample.bookings(spark, sf_dir),
        hotels=sample.hotels(spark),
        room_types=sample.room_types(spark),
        profiles=sample.guest_profiles(spark, sf_dir),
        tie_breakers=sample.TIE_BREAKERS,
        unique=True,
    )
    return lake, registry


# Feed.

def booking_feed(spark, sf_dir):
    return feed.as_feed(feed.measured(_numbered(spark, sf_dir)))


def booking_ids(spark, sf_dir):
    columns = ("arrival_date", "hotel", *sample.TIE_BREAKERS)
    return _numbered(spark, sf_dir, columns).select("booking_id", *columns)


def booking_csv_scan(spark, sf_dir):
    """Bookings through CSV text and back, with a scan by header name."""
    path = f"{work_folder(spark, 'csv')}/bookings"
    sample.bookings(spark, sf_dir).write.option("header", True).csv(path)
    return (
        feed.with_measures(files.read_bookings_csv(spark, path))
        .groupBy("hotel", "arrival_date")
        .agg(
            F.count("*").alias("bookings"),
            F.sum("total_nights").alias("nights"),
            F.sum("total_guests").alias("guests"),
            F.round(F.sum("adr"), 2).alias("rates"),
            F.round(F.sum("total_revenue"), 2).alias("revenue"),
        )
    )


def feed_rows_by_year(spark, sf_dir):
    """Rows of each yearly interval, read back from the JSON files."""
    path = f"{work_folder(spark, 'intervals')}/feed"
    loads.write_intervals(booking_feed(spark, sf_dir), path)
    return (
        files.read_feed(spark, f"{path}/interval_year=*")
        .groupBy("arrival_date_year")
        .agg(F.count("*").alias("rows"), F.sum("booking_id").alias("id_sum"))
        .orderBy("arrival_date_year")
    )


def feed_of_one_year(spark, sf_dir):
    return (
        _dated(spark, sf_dir)
        .filter(F.col("arrival_date_year") == sample.REPORT_YEAR)
        .select("date_key", "hotel", "country", "total_nights", "total_guests", "total_revenue")
    )


# Dimensions.

def dim_date(spark, sf_dir):
    return _calendar(spark, sf_dir).frame


def dim_hotel(spark, sf_dir):
    """The hotels that have bookings."""
    booked = sample.bookings(spark, sf_dir).select(F.col("hotel").alias("hotel_name")).distinct()
    hotels = dims.hotels(sample.hotels(spark)).join(booked, "hotel_name", "left_semi")
    return hotels.select(*schemas.DIM_HOTEL)


def dim_room_type(spark, sf_dir):
    """The room types that have bookings."""
    codes = sample.bookings(spark, sf_dir).select(F.col("reserved_room_type").alias("room_code"))
    booked = codes.distinct()
    return dims.room_types(sample.room_types(spark)).join(booked, "room_code", "left_semi")


def dim_guest_origin(spark, sf_dir):
    return dims.guest_origins(
        sample.guest_profiles(spark, sf_dir), work_folder(spark, "origins")
    )


def guest_origin_from_documents(spark, sf_dir):
    """The same dimension from profiles stored as JSON documents."""
    folder = work_folder(spark, "documents")
    sample.guest_profiles(spark, sf_dir).write.json(f"{folder}/profiles")
    profiles = files.read_documents(spark, f"{folder}/profiles")
    return dims.guest_origins(profiles, f"{folder}/origins")


def dim_hotel_incremental(spark, sf_dir):
    """Hotels with bookings, then a new one loaded twice: it is added once."""
    path = f"{work_folder(spark, 'incremental')}/dim_hotel"
    loads.overwrite(dim_hotel(spark, sf_dir), path)
    for _ in range(2):
        stored = loads.keyed_append(sample.new_hotels(spark), path, "hotel_key")
    return stored


def customers_incremental(spark, sf_dir):
    """Customers with orders before 1998 first, then all: every customer once."""
    path = f"{work_folder(spark, 'incremental')}/customers"
    customers = sample.given(spark, sf_dir, "customer")
    orders = sample.given(spark, sf_dir, "orders").filter(F.year("o_orderdate") < 1998)
    early = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    loads.overwrite(early, path)
    return loads.keyed_append(customers, path, "c_custkey").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def _changed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load: new balances for some customers, new customers, and two rows for some others."""
    customers = sample.given(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    changed = customers.filter(key % 7 == 0).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    same = customers.filter(key % 7 == 1)
    added = customers.filter(key % 7 == 2).withColumn("c_custkey", key + 10_000_000)
    doubtful = customers.filter(key % 7 == 3)
    other = doubtful.withColumn("c_name", F.lit("someone else"))
    return reduce(DataFrame.unionByName, (changed, same, same, added, doubtful, other))


def customers_merged(spark, sf_dir):
    """Customers after a load of changed and new ones; those with two rows in it stay as they were."""
    folder = work_folder(spark, "merge")
    path = f"{folder}/customers"
    merge.merge(sample.given(spark, sf_dir, "customer"), path, "c_custkey", f"{folder}/first")
    for k in range(2):
        merge.merge(_changed_customers(spark, sf_dir), path, "c_custkey", f"{folder}/again{k}")
    return merge.read_merged(spark, path).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def customer_merge_counts(spark, sf_dir):
    """What the first and the repeated load of changed customers did."""
    folder = work_folder(spark, "merge")
    path = f"{folder}/customers"
    merge.merge(sample.given(spark, sf_dir, "customer"), path, "c_custkey", f"{folder}/first")
    done = [
        merge.merge(_changed_customers(spark, sf_dir), path, "c_custkey", f"{folder}/again{k}")
        for k in range(2)
    ]
    rows = [(k, m.inserted, m.updated, m.unchanged, m.refused) for k, m in enumerate(done)]
    return spark.createDataFrame(
        rows, "load int, inserted bigint, updated bigint, unchanged bigint, refused bigint"
    )


# Bronze.

def _bronze(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, DataFrame]:
    lake = _lake(spark)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    land_feed(sample.bookings(spark, sf_dir), lake, sample.TIE_BREAKERS, unique=True)
    return lake, load_bronze(spark, lake)


def bronze_rows(spark, sf_dir):
    """Every streamed row with the file it came from."""
    return _bronze(spark, sf_dir)[1].drop("_ingest_timestamp")


def bronze_by_interval(spark, sf_dir):
    """One stream run for each interval as it lands, oldest year first; the first one twice."""
    lake = _lake(spark)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    bookings = booking_feed(spark, sf_dir)
    years = bookings.select("arrival_date_year").distinct().orderBy("arrival_date_year")
    landing = [row.arrival_date_year for row in years.collect()]
    return checks.rows_by_source(
        load_bronze_by_interval(bookings, lake, [*landing, *landing[:1]])
    )


def bronze_corrected(spark, sf_dir):
    """Bookings that stand after a corrected feed of the same source, the corrected ones marked.

    In the second version lines 3 have one more baby and lines 7 are gone.
    """
    lake = _lake(spark)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    # Both versions are cut from one stored copy, so that lines are joined once.
    bookings = copied(sample.bookings(spark, sf_dir), lake.staging("bookings"))
    line = F.col("l_linenumber")
    babies = F.when(line == 3, F.col("babies") + 1).otherwise(F.col("babies"))
    land_feed(bookings, lake, sample.TIE_BREAKERS, unique=True, source="bookings", stored=True)
    for _ in range(2):
        corrected = bookings.filter(line != 7).withColumn("babies", babies)
        land_feed(corrected, lake, sample.TIE_BREAKERS, unique=True, source="bookings", stored=True)
    first = bookings.count()
    load_bronze(spark, lake)
    return (
        standing_bronze(spark, lake)
        .groupBy("arrival_date_year", "hotel", (F.col("booking_id") > first).alias("corrected"))
        .agg(F.count("*").alias("rows"), F.sum("total_guests").alias("guests"))
    )


def bronze_restart(spark, sf_dir):
    """Rows after a second run on the same checkpoint, beside the rows of the source."""
    lake, _ = _bronze(spark, sf_dir)
    return checks.row_count_check(
        load_bronze(spark, lake), sample.given(spark, sf_dir, "lineitem")
    )


# Silver.

def silver_enriched(spark, sf_dir):
    bronze = _as_bronze(feed.measured(_numbered(spark, sf_dir)))
    return silver.enrich(bronze, _dimensions(spark, sf_dir)).drop("_ingest_timestamp")


def silver_unresolved_keys(spark, sf_dir):
    return checks.unresolved_keys(_silver(spark, sf_dir))


def silver_null_keys(spark, sf_dir):
    return checks.null_keys(_silver(spark, sf_dir))


def dimension_counts(spark, sf_dir):
    return checks.dimension_counts(_dimensions(spark, sf_dir).keyed())


def silver_streamed(spark, sf_dir):
    """Bronze streamed into Silver: rows and measures per hotel and year."""
    lake, _ = _bronze(spark, sf_dir)
    return (
        refresh_silver(spark, lake, _dimensions(spark, sf_dir))
        .groupBy("hotel_key", "year")
        .agg(
            F.count("*").alias("rows"),
            F.sum("booking_id").alias("id_sum"),
            F.sum("guest_origin_key").alias("origin_key_sum"),
            F.sum("room_type_key").alias("room_key_sum"),
            F.round(F.sum("total_revenue"), 2).alias("revenue"),
        )
    )


def hotel_added_before_silver(spark, sf_dir):
    """Silver with a hotel added to the CSV reference data, and with that hotel left out."""
    folder = work_folder(spark, "reference")
    new = sample.new_hotels(spark).select(F.col("hotel_key").alias("hotel_id"), "hotel_name")
    sample.hotels(spark).unionByName(new).write.option("header", True).csv(f"{folder}/hotels")
    sample.room_types(spark).write.option("header", True).csv(f"{folder}/rooms")
    listed = dims.hotels(files.read_hotels_csv(spark, f"{folder}/hotels"))
    rooms = dims.room_types(files.read_room_types_csv(spark, f"{folder}/rooms"))
    given = replace(_dimensions(spark, sf_dir), room_type=Dimension.counted(rooms))
    hotel = F.when(F.col("l_linenumber") == 7, sample.NEW_HOTEL_ROWS[0][1]).otherwise(F.col("hotel"))
    bookings = _dated(spark, sf_dir).withColumn("hotel", hotel)
    bronze = _as_bronze(bookings.withColumn("booking_id", F.col("l_orderkey")))

    def measured(hotels: DataFrame, added: bool) -> DataFrame:
        return (
            silver.enrich(bronze, replace(given, hotel=Dimension.counted(hotels)))
            .groupBy(F.lit(added).alias("added"), "hotel_key", "hotel_name", "room_name")
            .agg(F.count("*").alias("rows"), F.round(F.sum("total_revenue"), 2).alias("revenue"))
        )

    return measured(listed, True).unionByName(measured(silver.original_hotels(listed), False))


def _staged_bookings(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The feed under keys of its own, staged by year: what is landed in parts is joined once."""
    keyed = feed.with_arrival(sample.bookings(spark, sf_dir)).withColumn(
        "booking_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")
    )
    kept = keyed.select(*feed.feed_sources(keyed))
    with loads.open_files(spark):
        kept.write.partitionBy("arrival_date_year").option("compression", "zstd").parquet(folder)
    return feed.as_feed(feed.measured(spark.read.schema(kept.schema).parquet(folder)))


def _streamed_with_late_members(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Silver streamed in two loads, the second one with a hotel and a country that came late.

    The bookings before 1998 are streamed while only the resort hotel and the countries but
    NATION_12 are known, the others afterwards. Gold's state is kept up after each load.
    """
    lake = _lake(spark)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    bookings = _staged_bookings(spark, sf_dir, lake.staging("bookings"))
    profiles = sample.guest_profiles(spark, sf_dir)
    early = F.col("arrival_date_year") < 1998
    calendar, rooms, hotels = _calendar(spark, sf_dir), sample.room_types(spark), sample.hotels(spark)
    first_hotels = hotels.filter(F.col("hotel_name") == "Resort Hotel")
    first_guests = profiles.filter(F.col("country").isNull() | (F.col("country") != "NATION_12"))
    for rows, known_hotels, guests in (
        (bookings.filter(early), first_hotels, first_guests),
        (bookings.filter(~early), hotels, profiles),
    ):
        dimensions = load_dimensions(spark, lake, calendar, known_hotels, rooms, guests)
        loads.write_intervals(rows, lake.intervals)
        load_bronze(spark, lake)
        refresh_silver(spark, lake, dimensions)
        refresh_gold_state(spark, lake)
        resolve_late(spark, lake, dimensions)
    return lake


def silver_late_members(spark, sf_dir):
    """Streamed Silver after late members came. Keys are looked up in the dimension stored last."""
    lake = _streamed_with_late_members(spark, sf_dir)
    named = spark.table(lake.table("dim_guest_origin")).select(
        "guest_origin_key", F.col("country_code").alias("country_of_key")
    )
    return (
        streamed_silver(spark, lake)
        .join(named, "guest_origin_key", "left")
        .groupBy("hotel_key", "hotel_name", "guest_origin_key", "country_code", "country_of_key", "year")
        .agg(
            F.count("*").alias("rows"),
            F.sum("booking_id").alias("id_sum"),
            F.round(F.sum("total_revenue"), 2).alias("revenue"),
        )
    )


# Gold and reports.

def gold_revenue_by_hotel_year(spark, sf_dir):
    return gold.revenue_by_hotel_year(_silver(spark, sf_dir))


def gold_top_countries(spark, sf_dir):
    return gold.top_countries(_silver(spark, sf_dir))


def gold_room_performance(spark, sf_dir):
    return gold.room_performance(_silver(spark, sf_dir))


def gold_kept_up_revenue(spark, sf_dir):
    """Gold from the state that streamed Silver is added to, after late members came."""
    lake = _streamed_with_late_members(spark, sf_dir)
    return gold_state.revenue_by_hotel_year(refresh_gold_state(spark, lake, compact=True))


def gold_kept_up_rooms(spark, sf_dir):
    lake = _streamed_with_late_members(spark, sf_dir)
    return gold_state.room_performance(refresh_gold_state(spark, lake))


def q1_revenue_trend(spark, sf_dir):
    return reports.revenue_trend(spark, gold_revenue_by_hotel_year(spark, sf_dir))


def q2_leading_countries(spark, sf_dir):
    return reports.leading_countries(spark, gold_top_countries(spark, sf_dir))


def q3_weekend_share(spark, sf_dir):
    return reports.weekend_share(spark, gold_room_performance(spark, sf_dir))


def q4_quarterly_cancellations(spark, sf_dir):
    return reports.quarterly_cancellations(
        spark, _silver(spark, sf_dir), sample.REPORT_COUNTRIES, sample.REPORT_YEAR
    )


def q5_monthly_bookings(spark, sf_dir):
    return reports.monthly_bookings(spark, _silver(spark, sf_dir))


# The stored tables, end to end.

def table_registry(spark, sf_dir):
    return _built(spark, sf_dir)[1]


def stored_revenue_trend(spark, sf_dir):
    """The first report, by table name, on tables that were streamed and stored."""
    lake, _ = _built(spark, sf_dir)
    return reports.revenue_trend(spark, lake.table("gold_revenue_by_hotel_year"))


def stored_top_countries(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return spark.table(lake.table("gold_top_countries_revenue"))


def stored_room_performance(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return spark.table(lake.table("gold_room_type_performance"))


def stored_leading_countries(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return reports.leading_countries(spark, lake.table("gold_top_countries_revenue"))


def stored_weekend_share(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return reports.weekend_share(spark, lake.table("gold_room_type_performance"))


def stored_quarterly_cancellations(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return reports.quarterly_cancellations(
        spark, lake.table(SILVER), sample.REPORT_COUNTRIES, sample.REPORT_YEAR
    )


def stored_monthly_bookings(spark, sf_dir):
    lake, _ = _built(spark, sf_dir)
    return reports.monthly_bookings(spark, lake.table(SILVER))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        booking_feed,
        booking_ids,
        booking_csv_scan,
        feed_rows_by_year,
        feed_of_one_year,
        dim_date,
        dim_hotel,
        dim_room_type,
        dim_guest_origin,
        guest_origin_from_documents,
        dim_hotel_incremental,
        customers_incremental,
        customers_merged,
        customer_merge_counts,
        bronze_rows,
        bronze_by_interval,
        bronze_corrected,
        bronze_restart,
        silver_enriched,
        silver_unresolved_keys,
        silver_null_keys,
        dimension_counts,
        silver_streamed,
        silver_late_members,
        hotel_added_before_silver,
        gold_revenue_by_hotel_year,
        gold_top_countries,
        gold_room_performance,
        gold_kept_up_revenue,
        gold_kept_up_rooms,
        q1_revenue_trend,
        q2_leading_countries,
        q3_weekend_share,
        q4_quarterly_cancellations,
        q5_monthly_bookings,
        table_registry,
        stored_revenue_trend,
        stored_top_countries,
        stored_room_performance,
        stored_leading_countries,
        stored_weekend_share,
        stored_quarterly_cancellations,
        stored_monthly_bookings,
    )
}
