"""Calendar, hotel, room type and guest origin dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions import dates, measures, names
from roomledger.operators.keys import registered
from roomledger.operators.lookup import Dimension, lookup
from roomledger.operators.numbering import number_rows


# Arrivals outside are mistakes: they do not widen a calendar.
PLAUSIBLE = (dt.date(1900, 1, 1), dt.date(2100, 12, 31))
DAYS_PER_TASK = 100_000


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> Dimension:
    """One row for every day from first to last, both included."""
    days = max((last - first).days + 1, 0)
    tasks = days // DAYS_PER_TASK + 1
    numbered = spark.range(0, days, 1, tasks).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")
    )
    attributes = dates.calendar_attributes(F.col("full_date"))
    frame = numbered.select(*[column.alias(name) for name, column in attributes.items()])
    return Dimension(frame, days)


def _day(column: str) -> Column:
    """A date column, or the date that text starts with; NULL for other text."""
    return F.col(column).cast("string").try_cast("date")


def date_bounds(
    df: DataFrame, column: str = "arrival_date", within: tuple[dt.date, dt.date] | None = None
) -> tuple[dt.date, dt.date] | None:
    """First and last date of a column, of those within bounds if given; None if there is none."""
    day = F.col(column).cast("date")
    if within is not None:
        day = _day(column)
        day = F.when(day.between(*map(F.lit, within)), day)
    first, last = df.agg(F.min(day), F.max(day)).first()
    return (first, last) if first is not None else None


def stray_dates(
    df: DataFrame, column: str = "arrival_date", within: tuple[dt.date, dt.date] = PLAUSIBLE
) -> DataFrame:
    """The dates outside the bounds and how many rows have each: full_date, rows.

    Facts on them find no day in the calendar, keep their date_key and show in unresolved_keys.
    """
    day = _day(column)
    outside = df.select(day.alias("full_date")).filter(~F.col("full_date").between(*map(F.lit, within)))
    return outside.groupBy("full_date").agg(F.count("*").alias("rows")).orderBy("full_date")


def hotels(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("hotel_id").alias("hotel_key"),
        "hotel_name",
        names.hotel_type(F.col("hotel_name")).alias("hotel_type"),
    )


def room_types(source: DataFrame) -> DataFrame:
    return source.withColumnRenamed("room_type_id", "room_type_key")


def origin_profile(profiles: DataFrame) -> DataFrame:
    """Bookings, share with earlier cancellations and commonest segment per country.

    A missing country has no row. A missing cancellation count is not above 0, but
    counts in the share's base. The smallest of equally common segments is taken,
    Unknown where there is none. Bookings are first counted per country and
    segment, so a hot country reaches one task as a few rows.
    """
    per_segment = (
        profiles.filter(F.col("country").isNotNull())
        .groupBy("country", "market_segment")
        .agg(
            F.count("*").alias("_rows"),
            F.count_if(F.col("previous_cancellations") > 0).alias("_prior"),
        )
    )
    ranked = F.when(
        F.col("market_segment").isNotNull(), F.struct(-F.col("_rows"), F.col("market_segment"))
    )
    return (
        per_segment.groupBy(F.col("country").alias("country_code"))
        .agg(
            F.sum("_rows").alias("total_bookings"),
            measures.share_half_even(F.sum("_prior"), F.sum("_rows")).alias("cancellation_rate"),
            F.min(ranked).alias("_top"),
        )
        .select(
            "country_code",
            "total_bookings",
            "cancellation_rate",
            F.coalesce(F.col("_top.market_segment"), F.lit("Unknown")).alias("top_market_segment"),
        )
    )


def guest_origins(profiles: DataFrame, folder: str) -> DataFrame:
    """The guest origin dimension, keyed 1..n by country code."""
    keyed = number_rows(
        origin_profile(profiles), ["country_code"], "guest_origin_key", folder, unique=True
    )
    return keyed.select(
        F.col("guest_origin_key").cast("int").alias("guest_origin_key"),
        "country_code",
        "total_bookings",
        "cancellation_rate",
        "top_market_segment",
    )


def lasting_guest_origins(profiles: DataFrame, registry: str, folder: str) -> DataFrame:
    """The guest origin dimension with keys that are kept from load to load.

    A country keeps the key it was first given, new ones come after the largest. A country
    without profiles any more stays as a member, without bookings, since facts may point to it.
    """
    profile = origin_profile(profiles)
    stored = f"{folder}/profile"
    profile.write.parquet(stored)
    profile = profiles.sparkSession.read.parquet(stored)
    keys = registered(profile, "country_code", "guest_origin_key", registry, f"{folder}/keys")
    joined = lookup(keys, Dimension.counted(profile), "country_code")
    return joined.select(
        F.col("guest_origin_key").cast("int").alias("guest_origin_key"),
        "country_code",
        F.coalesce("total_bookings", F.lit(0)).alias("total_bookings"),
        "cancellation_rate",
        F.coalesce("top_market_segment", F.lit("Unknown")).alias("top_market_segment"),
    )
