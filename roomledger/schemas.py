"""Column names and types of the tables, in table order."""

from __future__ import annotations

# Raw booking transactions. Text files are read by header name and cast to these.
RAW_BOOKING = {
    "hotel": "string",
    "is_canceled": "int",
    "lead_time": "int",
    "arrival_date_year": "int",
    "arrival_date_month": "string",
    "arrival_date_day_of_month": "int",
    "stays_in_weekend_nights": "int",
    "stays_in_week_nights": "int",
    "adults": "int",
    "children": "int",
    "babies": "int",
    "meal": "string",
    "country": "string",
    "market_segment": "string",
    "distribution_channel": "string",
    "is_repeated_guest": "int",
    "reserved_room_type": "string",
    "deposit_type": "string",
    "customer_type": "string",
    "adr": "double",
    "total_of_special_requests": "int",
    "reservation_status": "string",
}

# The yearly feed, one JSON document per booking.
FEED = {
    "booking_id": "bigint",
    "date_key": "int",
    "arrival_date": "string",
    "hotel": "string",
    "reserved_room_type": "string",
    "is_canceled": "int",
    "lead_time": "int",
    "stays_in_weekend_nights": "int",
    "stays_in_week_nights": "int",
    "total_nights": "int",
    "adults": "int",
    "children": "int",
    "babies": "int",
    "total_guests": "int",
    "meal": "string",
    "country": "string",
    "market_segment": "string",
    "distribution_channel": "string",
    "is_repeated_guest": "int",
    "deposit_type": "string",
    "customer_type": "string",
    "adr": "double",
    "total_revenue": "double",
    "total_of_special_requests": "int",
    "reservation_status": "string",
    "arrival_date_year": "int",
}

LINEAGE = {"_ingest_timestamp": "timestamp", "_source_file": "string"}
BRONZE = {**FEED, **LINEAGE}

HOTELS = {"hotel_id": "int", "hotel_name": "string"}
ROOM_TYPES = {
    "room_type_id": "int",
    "room_code": "string",
    "room_name": "string",
    "base_rate_tier": "string",
}
DIM_HOTEL = {"hotel_key": "int", "hotel_name": "string", "hotel_type": "string"}

# The fields of a guest profile document that are used, and the id to drop.
GUEST_PROFILE = {
    "_id": "string",
    "country": "string",
    "previous_cancellations": "int",
    "market_segment": "string",
}

SILVER = (
    "booking_id",
    "date_key",
    "hotel_key",
    "guest_origin_key",
    "room_type_key",
    "hotel_name",
    "hotel_type",
    "country_code",
    "room_name",
    "base_rate_tier",
    "full_date",
    "year",
    "quarter",
    "month_name",
    "month_number",
    "day_name",
    "is_weekend",
    "is_canceled",
    "lead_time",
    "stays_in_weekend_nights",
    "stays_in_week_nights",
    "total_nights",
    "adults",
    "children",
    "babies",
    "total_guests",
    "meal_plan",
    "market_segment",
    "distribution_channel",
    "is_repeated_guest",
    "deposit_type",
    "customer_type",
    "adr",
    "total_revenue",
    "special_requests",
    "reservation_status",
    "_source_file",
    "_ingest_timestamp",
)


def ddl(columns: dict[str, str]) -> str:
    """The columns as a DDL string, as DataFrame readers take it."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def describe(df) -> list[tuple[str, str]]:
    """Name and type of each column, for a schema listing."""
    return list(df.dtypes)


def column_mapping(source, target) -> dict[str, object]:
    """How many columns went in and came out of a step, and which are new or gone."""
    return {
        "source_columns": len(source.columns),
        "target_columns": len(target.columns),
        "added": [c for c in target.columns if c not in source.columns],
        "dropped": [c for c in source.columns if c not in target.columns],
    }
