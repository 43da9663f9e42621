"""The Silver fact: bookings joined to all four dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.operators.lookup import MAX_BROADCAST_ROWS, Dimension, lookup, lookup_dealt

# Facts without a dimension row point to this member.
UNKNOWN_KEY = 0


@dataclass(frozen=True)
class Dimensions:
    date: Dimension
    hotel: Dimension
    guest_origin: Dimension
    room_type: Dimension

    def keyed(self) -> dict[str, tuple[DataFrame, str]]:
        """Each dimension with the key it is joined by."""
        return {
            "dim_date": (self.date.frame, "date_key"),
            "dim_hotel": (self.hotel.frame, "hotel_name"),
            "dim_guest_origin": (self.guest_origin.frame, "country_code"),
            "dim_room_type": (self.room_type.frame, "room_code"),
        }


def original_hotels(dim_hotel: DataFrame, last_key: int = 2) -> DataFrame:
    """Leave out hotels added after the first load."""
    return dim_hotel.filter(F.col("hotel_key") <= last_key)


def enrich(
    bronze: DataFrame,
    dims: Dimensions,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    keep: Mapping[str, str] = MappingProxyType({}),
    hot: Mapping[str, list] = MappingProxyType({}),
) -> DataFrame:
    """Bronze rows with their dimension attributes, one row out for each row in.

    Works on a batch or on a stream; the dimensions are static either way. keep names
    further columns of Bronze that come after Silver's, new name to name. hot has the hot
    values of join columns, as a stream needs them for dimensions too large to broadcast.
    """
    hotel = dims.hotel.select("hotel_key", "hotel_name", "hotel_type")
    origin = dims.guest_origin.select("guest_origin_key", "country_code")
    room = dims.room_type.select("room_type_key", "room_code", "room_name", "base_rate_tier")
    date = dims.date.select(
        "date_key",
        "full_date",
        "month_name",
        "month_number",
        "quarter",
        "year",
        "day_name",
        "is_weekend",
    )
    steps = (
        (hotel, "hotel", "hotel_name"),
        (origin, "country", "country_code"),
        (room, "reserved_room_type", "room_code"),
        (date, "date_key", "date_key"),
    )
    joined = bronze
    for dimension, own, member in steps:
        if own in hot and dimension.rows > max_broadcast_rows and own != member:
            joined = lookup_dealt(joined, dimension.frame, own, member, hot[own], "booking_id")
        else:
            on = own if own == member else F.col(own) == F.col(member)
            joined = lookup(joined, dimension, on, max_broadcast_rows)
    renamed = joined.withColumnsRenamed(
        {"meal": "meal_plan", "total_of_special_requests": "special_requests"}
    )
    kept = [F.col(name).alias(new) for new, name in keep.items()]
    return renamed.select(*schemas.SILVER, *kept).fillna(
        UNKNOWN_KEY, subset=["hotel_key", "guest_origin_key", "room_type_key"]
    )
