"""The given order tables read as reservation data. FIXTURES.md lists the mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.functions import dates
from roomledger.sources import files

# The reference tables of hotels and room types.
HOTEL_ROWS = [(1, "Resort Hotel"), (2, "City Hotel")]
ROOM_TYPE_ROWS = [
    (1, "A", "Standard Room", "Standard"),
    (2, "B", "Economy Room", "Budget"),
    (3, "C", "Comfort Room", "Standard"),
    (4, "D", "Deluxe Room", "Premium"),
    (5, "E", "Executive Suite", "Premium"),
    (6, "F", "Family Room", "Premium"),
    (7, "G", "Grand Suite", "Luxury"),
    (8, "H", "Honeymoon Suite", "Luxury"),
    (9, "L", "Luxury Penthouse", "Luxury"),
    (10, "P", "Presidential Suite", "Luxury"),
]
NEW_HOTEL_ROWS = [(99, "Lisbon Boutique Hotel", "City")]
# Room codes of the sample bookings; the last two have no room type.
ROOM_CODES = "ABCDEFGHLPXY"

# No two sample bookings agree in all of these.
TIE_BREAKERS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")

# Above so many parts Spark no longer broadcasts their four columns by its own threshold.
MOST_PARTS = 5_000_000

REPORT_COUNTRIES = tuple(f"NATION_{n}" for n in range(5))
REPORT_YEAR = 1996


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _guests(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer")
    nation = given(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name"
    )


def _int(column: Column) -> Column:
    return column.cast("int")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw booking transactions, one per order line, with their tie breakers."""
    orders = given(spark, sf_dir, "orders").withColumn("arrival", F.to_date("o_orderdate"))
    guests = _guests(spark, sf_dir)
    # What a line's columns are read as is computed before the shuffle: it is narrower than they are.
    lines = given(spark, sf_dir, "lineitem").select(
        *TIE_BREAKERS,
        _int(F.col("l_quantity").cast("int") % 6).alias("week_nights"),
        F.to_date("l_shipdate").alias("shipped"),
        (F.col("l_returnflag") == "R").alias("canceled"),
        (F.col("l_linestatus") == "O").alias("resort"),
    )
    parts = given(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    placed = orders.join(guests, F.col("o_custkey") == F.col("c_custkey"))
    # Lines and orders both grow with the data: they are shuffled on their key at any
    # size, hot keys being split at run time. Other sides are broadcast while small.
    # Parts too many for it are joined first, while lines are narrow: both joins shuffle them then,
    # and what is written still lies by order.
    of_order, of_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    if parts.count() > MOST_PARTS:
        joined = lines.join(parts, of_part).join(placed.hint("merge"), of_order)
    else:
        joined = lines.join(placed.hint("merge"), of_order).join(parts, of_part)
    arrival = F.col("arrival")
    canceled = F.col("canceled")
    columns = {
        "hotel": F.when(F.col("resort"), "Resort Hotel").otherwise("City Hotel"),
        "is_canceled": F.when(canceled, 1).otherwise(0),
        "lead_time": _int(F.abs(F.datediff(F.col("shipped"), arrival))),
        "arrival_date_year": F.year(arrival),
        "arrival_date_month": F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month(arrival)),
        "arrival_date_day_of_month": F.dayofmonth(arrival),
        "stays_in_weekend_nights": _int(F.col("l_linenumber") % 3),
        "stays_in_week_nights": F.col("week_nights"),
        "adults": _int(1 + F.col("l_suppkey") % 3),
        "children": _int(F.col("l_partkey") % 2),
        "babies": F.lit(0),
        "meal": F.col("p_type"),
        "country": F.when(F.col("c_nationkey") != 23, F.col("n_name")),
        "market_segment": F.col("c_mktsegment"),
        "distribution_channel": F.col("o_orderpriority"),
        "is_repeated_guest": _int(F.col("o_custkey") % 2),
        "reserved_room_type": F.substring(F.lit(ROOM_CODES), 1 + F.col("p_size") % 12, F.lit(1)),
        "deposit_type": F.col("o_orderstatus"),
        "customer_type": F.col("p_brand"),
        "adr": F.col("c_acctbal"),
        "total_of_special_requests": _int(F.col("l_suppkey") % 5),
        "reservation_status": F.when(canceled, "Canceled").otherwise("Check-Out"),
    }
    return joined.select(*[column.alias(name) for name, column in columns.items()], *TIE_BREAKERS)


def guest_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guest profile documents, one per order.

    One nation has none, one has profiles without its name, one has no market segments.
    """
    guests = _guests(spark, sf_dir).filter(F.col("c_nationkey") != 24)
    orders = given(spark, sf_dir, "orders")
    named = F.when(F.col("c_nationkey") != 23, F.col("n_name"))
    has_segment = (F.col("o_orderkey") % 5 != 0) & (F.col("c_nationkey") != 22)
    segment = F.when(has_segment, F.col("c_mktsegment"))
    return orders.join(guests, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("_id"),
        named.alias("country"),
        _int(F.col("o_custkey") % 3).alias("previous_cancellations"),
        segment.alias("market_segment"),
    )


def hotels(spark: SparkSession) -> DataFrame:
    return files.rows(spark, HOTEL_ROWS, schemas.HOTELS)


def room_types(spark: SparkSession) -> DataFrame:
    return files.rows(spark, ROOM_TYPE_ROWS, schemas.ROOM_TYPES)


def new_hotels(spark: SparkSession) -> DataFrame:
    return files.rows(spark, NEW_HOTEL_ROWS, schemas.DIM_HOTEL)
