"""Month lookup, arrival dates, integer date keys and calendar attributes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)


def month_number(name: Column) -> Column:
    """Number of an English month name; NULL for any other text."""
    pairs = ((F.lit(month), F.lit(n)) for n, month in enumerate(MONTHS, start=1))
    return F.try_element_at(F.create_map(*chain.from_iterable(pairs)), name)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL if a part is missing or there is no such day.

    Built from numbers: no text is padded, joined and parsed per row. Days that every month has
    need no check; a timestamp, whose seconds are a decimal per row, is only made of others.
    """
    midnight = (F.lit(0), F.lit(0), F.lit(0))
    checked = F.try_make_timestamp_ntz(year, month, day, *midnight).cast("date")
    plain = year.between(1, 9999) & month.between(1, 12) & day.between(1, 28)
    return F.when(plain, F.make_date(year, month, day)).otherwise(checked)


def date_key(day: Column) -> Column:
    """yyyymmdd as an int, by arithmetic: no text is formatted per row."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The ten columns of the calendar dimension, in order."""
    weekday = F.weekday(day)
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.when(weekday >= 5, 1).otherwise(0),
    }
