"""Booking measures per row, and the aggregates that reports are made of.

Rounding is half up, except where half_even is named.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_rate(rate: Column) -> Column:
    """Negative rates become 0; NULL stays NULL."""
    return F.when(rate < 0, 0.0).otherwise(rate)


def stay_revenue(rate: Column, nights: Column) -> Column:
    """Rate times nights to the cent, 0 for a negative rate."""
    return F.when(rate < 0, 0.0).otherwise(F.round(rate * nights, 2))


def mean(name: str, digits: int) -> Column:
    return F.round(F.avg(name), digits)


def money(name: str) -> Column:
    return F.round(F.sum(name), 2)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL for a whole of 0 (also in ANSI mode)."""
    return part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Share on a 0-100 scale, one decimal."""
    return F.round(ratio(part, whole) * 100, 1)


def share_half_even(part: Column, whole: Column) -> Column:
    """Share on a 0-1 scale, four decimals, ties to the even digit."""
    return F.bround(ratio(part, whole), 4)


# Named aggregates over Silver columns, shared by Gold tables and reports.

def bookings() -> Column:
    return F.count("booking_id").alias("total_bookings")


def canceled(name: str) -> Column:
    return F.sum("is_canceled").alias(name)


def cancel_pct() -> Column:
    return percent(F.sum("is_canceled"), F.count("booking_id")).alias("cancel_pct")


def daily_rate() -> Column:
    return mean("adr", 2).alias("avg_daily_rate")


def stay_nights() -> Column:
    return mean("total_nights", 1).alias("avg_stay_nights")


def party_size() -> Column:
    return mean("total_guests", 1).alias("avg_party_size")


def revenue() -> Column:
    return money("total_revenue").alias("total_revenue")


def revenue_per_booking() -> Column:
    per_booking = ratio(F.sum("total_revenue"), F.count("booking_id"))
    return F.round(per_booking, 2).alias("revenue_per_booking")
