"""Gold tables: small aggregates of Silver, partly combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions import measures as m


def completed_stays(silver: DataFrame) -> DataFrame:
    """Bookings known not to be canceled."""
    return silver.filter(F.col("is_canceled") == 0)


def revenue_by_hotel_year(silver: DataFrame) -> DataFrame:
    """All bookings, canceled ones included, also in the revenue."""
    measures = (
        m.bookings(),
        m.canceled("total_cancellations"),
        m.cancel_pct(),
        m.daily_rate(),
        m.stay_nights(),
        m.revenue(),
    )
    return (
        silver.groupBy("hotel_name", "hotel_type", "year")
        .agg(*measures)
        .orderBy("year", "hotel_name")
    )


def top_countries(silver: DataFrame, k: int = 15) -> DataFrame:
    """The k pairs of country and hotel with the highest revenue of completed stays."""
    measures = (m.bookings(), m.stay_nights(), m.daily_rate(), m.party_size(), m.revenue())
    return (
        completed_stays(silver)
        .groupBy("country_code", "hotel_name")
        .agg(*measures)
        .orderBy(F.desc("total_revenue"), "country_code", "hotel_name")
        .limit(k)
    )


def room_performance(silver: DataFrame) -> DataFrame:
    """Completed stays per room type."""
    measures = (
        m.bookings(),
        m.mean("stays_in_weekend_nights", 1).alias("avg_weekend_nights"),
        m.mean("stays_in_week_nights", 1).alias("avg_weekday_nights"),
        m.daily_rate(),
        m.revenue(),
        m.revenue_per_booking(),
    )
    return (
        completed_stays(silver)
        .groupBy("room_name", "base_rate_tier")
        .agg(*measures)
        .orderBy(F.desc("total_revenue"), "room_name")
    )
