"""Expressions over names: hotel type, source file, table layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: the yearly feed's file name.
FEED_FILE = r"(fact_stream_\d{4}\.json)"
# The directory that a partitioned write gives an interval.
INTERVAL_DIR = r"/interval_year=(\d{4})/"


def hotel_type(name: Column) -> Column:
    return F.when(name.contains("Resort"), "Resort").otherwise("City")


def feed_file(year: Column) -> Column:
    """File name of a year's interval; an empty string without a year."""
    named = F.concat(F.lit("fact_stream_"), year.cast("string"), F.lit(".json"))
    return F.coalesce(named, F.lit(""))


def source_file(path: Column) -> Column:
    """Feed file name of a path, from the file's own name or its interval directory.

    An empty string if the path shows neither.
    """
    interval = F.regexp_extract(path, INTERVAL_DIR, 1)
    return F.when(interval != "", feed_file(interval)).otherwise(
        F.regexp_extract(path, FEED_FILE, 1)
    )


def table_layer(name: Column) -> Column:
    """Layer by the first of dim, bronze and silver found in the name, else GOLD."""
    return (
        F.when(name.contains("dim"), "DIM")
        .when(name.contains("bronze"), "BRONZE")
        .when(name.contains("silver"), "SILVER")
        .otherwise("GOLD")
    )
