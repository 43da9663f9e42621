"""From raw booking transactions to the dated, numbered and cleaned feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.functions import dates, measures
from roomledger.operators.numbering import number_rows, partitions_for


def with_arrival(raw: DataFrame) -> DataFrame:
    """Add the arrival date."""
    month = dates.month_number(F.col("arrival_date_month"))
    day = F.col("arrival_date_day_of_month")
    return raw.withColumn(
        "arrival_date", dates.date_from_parts(F.col("arrival_date_year"), month, day)
    )


def with_measures(raw: DataFrame) -> DataFrame:
    """Add arrival date, date key, nights, guests and revenue; clean the rate."""
    return measured(with_arrival(raw))


def measured(dated: DataFrame) -> DataFrame:
    """Add date key, nights, guests and revenue to bookings with an arrival date; clean the rate."""
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    return dated.withColumn("total_nights", nights).withColumns(
        {
            "date_key": dates.date_key(F.col("arrival_date")),
            "total_guests": F.col("adults") + F.col("children") + F.col("babies"),
            "total_revenue": measures.stay_revenue(F.col("adr"), F.col("total_nights")),
            "adr": measures.clamp_rate(F.col("adr")),
        }
    )


def tie_breakers() -> list[str]:
    """All raw columns but the hotel, by which bookings of one date and hotel are numbered."""
    return [c for c in schemas.RAW_BOOKING if c != "hotel"]


def numbered(
    dated: DataFrame,
    folder: str,
    ties: Sequence[str] | None = None,
    first_id: int = 1,
    unique: bool = False,
    rows: int | None = None,
    keep: Sequence[str | Column] | None = None,
    codec: str = "zstd",
) -> DataFrame:
    """Add booking_id, counting by arrival date and hotel, to bookings with an arrival date.

    Bookings of one date and hotel are numbered by ties, so that ids
    do not change between runs: all other raw columns unless given. Bookings of a
    later feed take a first_id above those given out. unique: no two bookings agree in
    date, hotel and ties, so that no copy of the rows is needed to tell them apart.
    rows: about how many there are, from which the number of tasks that sort them follows.
    keep: the columns that come out beside booking_id, all unless given. codec: how the sorted
    rows are compressed while they are staged.

    Measures are best added afterwards, so that they are neither shuffled nor stored; a rate
    counts in the order as it is after cleaning, whether it was cleaned before or not.
    """
    order = ["arrival_date", "hotel", *(tie_breakers() if ties is None else ties)]
    clean = measures.clamp_rate(F.col("adr")) if "adr" in order else None
    by = [clean if name == "adr" else name for name in order]
    partitions = None if rows is None else partitions_for(dated.sparkSession, rows)
    return number_rows(
        dated, by, "booking_id", folder, unique=unique, partitions=partitions, first=first_id,
        keep=keep, codec=codec,
    )


def feed_sources(dated: DataFrame) -> list[str]:
    """The columns of bookings with an arrival date that the feed and its measures follow from."""
    return [c for c in dated.columns if c in schemas.FEED]


def as_feed(numbered_bookings: DataFrame) -> DataFrame:
    """The 26 feed columns in order and type."""
    return numbered_bookings.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in schemas.FEED.items()]
    )


def booking_feed(
    raw: DataFrame,
    folder: str,
    ties: Sequence[str] | None = None,
    first_id: int = 1,
    unique: bool = False,
) -> DataFrame:
    dated = with_arrival(raw)
    ids = numbered(dated, folder, ties, first_id, unique, keep=feed_sources(dated))
    return as_feed(measured(ids))
