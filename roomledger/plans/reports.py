"""Reports over Gold and Silver tables, given as frames or by catalog name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions import measures as m

# Country codes and year of the quarterly report.
REPORT_COUNTRIES = ("PRT", "GBR", "FRA", "ESP", "DEU")
REPORT_YEAR = 2016


def table(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    return spark.table(source) if isinstance(source, str) else source


def revenue_trend(spark: SparkSession, gold_revenue: DataFrame | str) -> DataFrame:
    """Is the cancellation rate falling, and which hotel earns more?"""
    named = table(spark, gold_revenue).withColumnRenamed("cancel_pct", "cancellation_pct")
    return spark.sql("SELECT * FROM {trend} ORDER BY year, hotel_name", trend=named)


def leading_countries(
    spark: SparkSession, gold_countries: DataFrame | str, k: int = 10
) -> DataFrame:
    """Which guest origins bring most revenue, and how do they stay?"""
    return spark.sql(
        "SELECT * FROM {countries} "
        "ORDER BY total_revenue DESC, country_code, hotel_name LIMIT :k",
        args={"k": k},
        countries=table(spark, gold_countries),
    )


def weekend_share(spark: SparkSession, gold_rooms: DataFrame | str) -> DataFrame:
    """How much of a room type's nights fall on weekends, beside its revenue?"""
    rooms = table(spark, gold_rooms)
    weekend, weekday = F.col("avg_weekend_nights"), F.col("avg_weekday_nights")
    share = m.percent(weekend, weekend + weekday).alias("pct_weekend_stays")
    leading = [c for c in rooms.columns if c not in _RATE_COLUMNS]
    return rooms.select(*leading, share, *_RATE_COLUMNS).orderBy(
        F.desc("total_revenue"), "room_name"
    )


_RATE_COLUMNS = ("avg_daily_rate", "total_revenue", "revenue_per_booking")


def quarterly_cancellations(
    spark: SparkSession,
    silver: DataFrame | str,
    countries: Sequence[str] = REPORT_COUNTRIES,
    year: int = REPORT_YEAR,
    min_bookings: int = 50,
) -> DataFrame:
    """Which of these countries cancel most, by quarter of one year?"""
    chosen = F.col("country_code").isin(*countries) & (F.col("year") == year)
    return (
        table(spark, silver)
        .filter(chosen)
        .groupBy("year", "quarter", "hotel_name", "country_code")
        .agg(
            m.bookings(),
            m.canceled("cancellations"),
            m.cancel_pct(),
            m.mean("lead_time", 0).alias("avg_lead_time_days"),
        )
        .filter(F.col("total_bookings") >= min_bookings)
        .orderBy("quarter", F.desc("cancel_pct"), "hotel_name", "country_code")
    )


def monthly_bookings(spark: SparkSession, silver: DataFrame | str) -> DataFrame:
    """When is the peak season, and how does the rate move with it?"""
    return (
        table(spark, silver)
        .groupBy("year", "month_number", "month_name", "hotel_name")
        .agg(
            m.bookings(),
            m.canceled("cancellations"),
            m.daily_rate(),
            m.revenue(),
            m.party_size(),
        )
        .orderBy("year", "month_number", "hotel_name")
    )
