"""DuckDB SQL for the registered queries, over views of the given tables."""

from __future__ import annotations

# The reference tables, as in catalog.sample.
_FIXED = """
hotels(hotel_key, hotel_name, hotel_type) AS (
    VALUES (1, 'Resort Hotel', 'Resort'), (2, 'City Hotel', 'City')
),
rooms(room_type_key, room_code, room_name, base_rate_tier) AS (
    VALUES
        (1, 'A', 'Standard Room', 'Standard'),
        (2, 'B', 'Economy Room', 'Budget'),
        (3, 'C', 'Comfort Room', 'Standard'),
        (4, 'D', 'Deluxe Room', 'Premium'),
        (5, 'E', 'Executive Suite', 'Premium'),
        (6, 'F', 'Family Room', 'Premium'),
        (7, 'G', 'Grand Suite', 'Luxury'),
        (8, 'H', 'Honeymoon Suite', 'Luxury'),
        (9, 'L', 'Luxury Penthouse', 'Luxury'),
        (10, 'P', 'Presidential Suite', 'Luxury')
)
"""

_BOOKINGS = """
sourced AS (
    SELECT
        CASE WHEN l_linestatus = 'O' THEN 'Resort Hotel' ELSE 'City Hotel' END AS hotel,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_canceled,
        CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INT)
            AS lead_time,
        CAST(o_orderdate AS DATE) AS arrival,
        CAST(l_linenumber % 3 AS INT) AS stays_in_weekend_nights,
        CAST(CAST(trunc(l_quantity) AS INT) % 6 AS INT) AS stays_in_week_nights,
        CAST(1 + l_suppkey % 3 AS INT) AS adults,
        CAST(l_partkey % 2 AS INT) AS children,
        0 AS babies,
        p_type AS meal,
        CASE WHEN c_nationkey <> 23 THEN n_name END AS country,
        c_mktsegment AS market_segment,
        o_orderpriority AS distribution_channel,
        CAST(o_custkey % 2 AS INT) AS is_repeated_guest,
        substr('ABCDEFGHLPXY', CAST(1 + p_size % 12 AS INT), 1) AS reserved_room_type,
        o_orderstatus AS deposit_type,
        p_brand AS customer_type,
        c_acctbal AS raw_adr,
        CAST(l_suppkey % 5 AS INT) AS total_of_special_requests,
        CASE WHEN l_returnflag = 'R' THEN 'Canceled' ELSE 'Check-Out' END AS reservation_status,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
),
dated AS (
    SELECT
        *,
        CAST(strftime(arrival, '%Y%m%d') AS INT) AS date_key,
        CAST(year(arrival) AS INT) AS arrival_date_year,
        stays_in_weekend_nights + stays_in_week_nights AS total_nights,
        adults + children + babies AS total_guests,
        CASE WHEN raw_adr < 0 THEN 0.0 ELSE raw_adr END AS adr,
        CASE WHEN raw_adr < 0 THEN 0.0
             ELSE round(raw_adr * (stays_in_weekend_nights + stays_in_week_nights), 2)
        END AS total_revenue,
        'fact_stream_' || year(arrival) || '.json' AS _source_file
    FROM sourced
)
"""

_NUMBERED = """
numbered AS (
    SELECT
        *,
        row_number() OVER (
            ORDER BY arrival, hotel,
                l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        ) AS booking_id
    FROM dated
)
"""

_ORIGINS = """
profiles AS (
    SELECT
        CASE WHEN c_nationkey <> 23 THEN n_name END AS country,
        o_custkey % 3 AS previous_cancellations,
        CASE WHEN o_orderkey % 5 <> 0 AND c_nationkey <> 22 THEN c_mktsegment END AS market_segment
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE c_nationkey <> 24
),
segments AS (
    SELECT
        country, market_segment,
        row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, market_segment) AS place
    FROM profiles
    WHERE market_segment IS NOT NULL
    GROUP BY country, market_segment
),
counted AS (
    SELECT
        country,
        count(*) AS total_bookings,
        round_even(
            CAST(count(*) FILTER (WHERE previous_cancellations > 0) AS DOUBLE) / count(*), 4
        ) AS cancellation_rate
    FROM profiles
    WHERE country IS NOT NULL
    GROUP BY country
),
origins AS (
    SELECT
        CAST(row_number() OVER (ORDER BY counted.country) AS INT) AS guest_origin_key,
        counted.country AS country_code,
        total_bookings,
        cancellation_rate,
        coalesce(market_segment, 'Unknown') AS top_market_segment
    FROM counted
    LEFT JOIN segments ON segments.country = counted.country AND place = 1
)
"""

_CALENDAR = """
bounds AS (
    SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
    FROM orders
),
days AS (
    SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS full_date
    FROM bounds
),
calendar AS (
    SELECT
        CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key,
        full_date,
        CAST(day(full_date) AS INT) AS day_of_month,
        CAST(month(full_date) AS INT) AS month_number,
        strftime(full_date, '%B') AS month_name,
        CAST(quarter(full_date) AS INT) AS quarter,
        CAST(year(full_date) AS INT) AS year,
        CAST(isodow(full_date) - 1 AS INT) AS day_of_week,
        strftime(full_date, '%A') AS day_name,
        CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
    FROM days
)
"""

_FEED_COLUMNS = """
    booking_id, date_key, strftime(arrival, '%Y-%m-%d') AS arrival_date, hotel,
    reserved_room_type, is_canceled, lead_time, stays_in_weekend_nights, stays_in_week_nights,
    total_nights, adults, children, babies, total_guests, meal, country, market_segment,
    distribution_channel, is_repeated_guest, deposit_type, customer_type, adr, total_revenue,
    total_of_special_requests, reservation_status, arrival_date_year
"""


def _silver(fact: str, booking_id: str) -> str:
    return f"""
silver AS (
    SELECT
        {booking_id} AS booking_id,
        {fact}.date_key,
        coalesce(hotels.hotel_key, 0) AS hotel_key,
        coalesce(origins.guest_origin_key, 0) AS guest_origin_key,
        coalesce(rooms.room_type_key, 0) AS room_type_key,
        hotels.hotel_name, hotels.hotel_type, origins.country_code,
        rooms.room_name, rooms.base_rate_tier,
        calendar.full_date, calendar.year, calendar.quarter, calendar.month_name,
        calendar.month_number, calendar.day_name, calendar.is_weekend,
        is_canceled, lead_time, stays_in_weekend_nights, stays_in_week_nights, total_nights,
        adults, children, babies, total_guests, meal AS meal_plan, market_segment,
        distribution_channel, is_repeated_guest, deposit_type, customer_type,
        adr, total_revenue, total_of_special_requests AS special_requests,
        reservation_status, _source_file
    FROM {fact}
    LEFT JOIN hotels ON {fact}.hotel = hotels.hotel_name
    LEFT JOIN origins ON {fact}.country = origins.country_code
    LEFT JOIN rooms ON {fact}.reserved_room_type = rooms.room_code
    LEFT JOIN calendar ON {fact}.date_key = calendar.date_key
)
"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


_LAZY_SILVER = (_FIXED, _BOOKINGS, _ORIGINS, _CALENDAR, _silver("dated", "l_orderkey"))
_FULL_SILVER = (
    _FIXED,
    _BOOKINGS,
    _NUMBERED,
    _ORIGINS,
    _CALENDAR,
    _silver("numbered", "booking_id"),
)

_CANCEL_PCT = "round(sum(is_canceled) / count(booking_id) * 100, 1)"
_SUM_CANCELED = "CAST(sum(is_canceled) AS BIGINT)"

_GOLD_REVENUE = f"""
gold_revenue AS (
    SELECT
        hotel_name, hotel_type, year,
        count(booking_id) AS total_bookings,
        {_SUM_CANCELED} AS total_cancellations,
        {_CANCEL_PCT} AS cancel_pct,
        round(avg(adr), 2) AS avg_daily_rate,
        round(avg(total_nights), 1) AS avg_stay_nights,
        round(sum(total_revenue), 2) AS total_revenue
    FROM silver
    GROUP BY hotel_name, hotel_type, year
)
"""

_GOLD_COUNTRIES = """
gold_countries AS (
    SELECT
        country_code, hotel_name,
        count(booking_id) AS total_bookings,
        round(avg(total_nights), 1) AS avg_stay_nights,
        round(avg(adr), 2) AS avg_daily_rate,
        round(avg(total_guests), 1) AS avg_party_size,
        round(sum(total_revenue), 2) AS total_revenue
    FROM silver
    WHERE is_canceled = 0
    GROUP BY country_code, hotel_name
    ORDER BY total_revenue DESC, country_code NULLS FIRST, hotel_name NULLS FIRST
    LIMIT 15
)
"""

_GOLD_ROOMS = """
gold_rooms AS (
    SELECT
        room_name, base_rate_tier,
        count(booking_id) AS total_bookings,
        round(avg(stays_in_weekend_nights), 1) AS avg_weekend_nights,
        round(avg(stays_in_week_nights), 1) AS avg_weekday_nights,
        round(avg(adr), 2) AS avg_daily_rate,
        round(sum(total_revenue), 2) AS total_revenue,
        round(sum(total_revenue) / count(booking_id), 2) AS revenue_per_booking
    FROM silver
    WHERE is_canceled = 0
    GROUP BY room_name, base_rate_tier
)
"""

_TREND = """
SELECT * RENAME (cancel_pct AS cancellation_pct) FROM gold_revenue
"""

_BOOKED_HOTELS = """
SELECT hotel_key, hotel_name, hotel_type FROM hotels
WHERE hotel_name IN (SELECT hotel FROM sourced)
"""

_BY_INTERVAL = 'SELECT _source_file, count(*) AS "rows" FROM dated GROUP BY _source_file'

ORACLE: dict[str, str] = {
    "booking_feed": _with(_BOOKINGS, _NUMBERED, select=f"SELECT {_FEED_COLUMNS} FROM numbered"),
    "booking_ids": _with(
        _BOOKINGS,
        _NUMBERED,
        select="""
        SELECT booking_id, arrival AS arrival_date, hotel,
            l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM numbered
        """,
    ),
    "booking_csv_scan": _with(
        _BOOKINGS,
        select="""
        SELECT
            hotel, arrival AS arrival_date,
            count(*) AS bookings,
            CAST(sum(total_nights) AS BIGINT) AS nights,
            CAST(sum(total_guests) AS BIGINT) AS guests,
            round(sum(adr), 2) AS rates,
            round(sum(total_revenue), 2) AS revenue
        FROM dated
        GROUP BY hotel, arrival
        """,
    ),
    "feed_rows_by_year": _with(
        _BOOKINGS,
        _NUMBERED,
        select="""
        SELECT arrival_date_year, count(*) AS "rows", CAST(sum(booking_id) AS BIGINT) AS id_sum
        FROM numbered
        GROUP BY arrival_date_year
        """,
    ),
    "feed_of_one_year": _with(
        _BOOKINGS,
        select="""
        SELECT date_key, hotel, country, total_nights, total_guests, total_revenue
        FROM dated
        WHERE arrival_date_year = 1996
        """,
    ),
    "dim_date": _with(_CALENDAR, select="SELECT * FROM calendar"),
    "dim_hotel": _with(_FIXED, _BOOKINGS, select=_BOOKED_HOTELS),
    "dim_room_type": _with(
        _FIXED,
        _BOOKINGS,
        select="""
        SELECT * FROM rooms WHERE room_code IN (SELECT reserved_room_type FROM sourced)
        """,
    ),
    "dim_guest_origin": _with(_ORIGINS, select="SELECT * FROM origins"),
    "guest_origin_from_documents": _with(_ORIGINS, select="SELECT * FROM origins"),
    "dim_hotel_incremental": _with(
        _FIXED,
        _BOOKINGS,
        select=f"{_BOOKED_HOTELS} UNION ALL SELECT 99, 'Lisbon Boutique Hotel', 'City'",
    ),
    "customers_incremental": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
    "customers_merged": """
        SELECT c_custkey, c_name, c_nationkey,
            CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer
        UNION ALL
        SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 7 = 2
    """,
    "customer_merge_counts": """
        SELECT load::INT AS load,
            count(*) FILTER (load = 0 AND c_custkey % 7 = 2) AS inserted,
            count(*) FILTER (load = 0 AND c_custkey % 7 = 0) AS updated,
            count(*) FILTER (c_custkey % 7 = 1 OR (load = 1 AND c_custkey % 7 IN (0, 2))) AS unchanged,
            count(*) FILTER (c_custkey % 7 = 3) AS refused
        FROM customer CROSS JOIN range(2) AS loads(load) GROUP BY load
    """,
    "bronze_corrected": _with(
        _BOOKINGS,
        select="""
        SELECT arrival_date_year, hotel, l_linenumber = 3 AS corrected, count(*) AS "rows",
            CAST(sum(total_guests + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS BIGINT) AS guests
        FROM dated WHERE l_linenumber <> 7 GROUP BY arrival_date_year, hotel, l_linenumber = 3
        """,
    ),
    "bronze_rows": _with(
        _BOOKINGS, _NUMBERED, select=f"SELECT {_FEED_COLUMNS}, _source_file FROM numbered"
    ),
    "bronze_by_interval": _with(_BOOKINGS, select=_BY_INTERVAL),
    "bronze_restart": """
        SELECT count(*) AS "rows", count(*) AS expected_rows, 1 AS matches FROM lineitem
    """,
    "silver_enriched": _with(*_FULL_SILVER, select="SELECT * FROM silver"),
    "silver_unresolved_keys": _with(
        *_LAZY_SILVER,
        select="""
        SELECT
            count(*) AS total_rows,
            count(*) FILTER (WHERE hotel_key = 0) AS unknown_hotel,
            count(*) FILTER (WHERE guest_origin_key = 0) AS unknown_guest_origin,
            count(*) FILTER (WHERE room_type_key = 0) AS unknown_room_type,
            count(*) FILTER (WHERE full_date IS NULL) AS unknown_date
        FROM silver
        """,
    ),
    "silver_null_keys": _with(
        *_LAZY_SILVER,
        select="""
        SELECT
            count(*) AS total_rows,
            count(*) FILTER (WHERE hotel_key IS NULL) AS null_hotel_key,
            count(*) FILTER (WHERE guest_origin_key IS NULL) AS null_guest_origin_key,
            count(*) FILTER (WHERE room_type_key IS NULL) AS null_room_type_key,
            count(*) FILTER (WHERE date_key IS NULL) AS null_date_key
        FROM silver
        """,
    ),
    "dimension_counts": _with(
        _FIXED,
        _ORIGINS,
        _CALENDAR,
        select="""
        SELECT 'dim_date' AS dimension, count(*) AS "rows",
            count(*) - count(DISTINCT date_key) AS repeated_keys FROM calendar
        UNION ALL
        SELECT 'dim_hotel', count(*), count(*) - count(DISTINCT hotel_name) FROM hotels
        UNION ALL
        SELECT 'dim_guest_origin', count(*), count(*) - count(DISTINCT country_code) FROM origins
        UNION ALL
        SELECT 'dim_room_type', count(*), count(*) - count(DISTINCT room_code) FROM rooms
        """,
    ),
    "silver_streamed": _with(
        *_FULL_SILVER,
        select="""
        SELECT
            hotel_key, year,
            count(*) AS "rows",
            CAST(sum(booking_id) AS BIGINT) AS id_sum,
            CAST(sum(guest_origin_key) AS BIGINT) AS origin_key_sum,
            CAST(sum(room_type_key) AS BIGINT) AS room_key_sum,
            round(sum(total_revenue), 2) AS revenue
        FROM silver
        GROUP BY hotel_key, year
        """,
    ),
    "silver_late_members": _with(
        _FIXED,
        _BOOKINGS,
        _ORIGINS,
        _CALENDAR,
        """
        kept_keys AS (
            SELECT CAST(row_number() OVER (ORDER BY country_code = 'NATION_12', country_code) AS INT) AS kept,
                country_code AS code
            FROM origins
        )
        """,
        _silver("dated", "l_orderkey * 8 + l_linenumber"),
        select="""
        SELECT hotel_key, hotel_name, coalesce(kept, 0) AS guest_origin_key, country_code,
            country_code AS country_of_key, year, count(*) AS "rows",
            CAST(sum(booking_id) AS BIGINT) AS id_sum, round(sum(total_revenue), 2) AS revenue
        FROM silver LEFT JOIN kept_keys ON country_code = code
        GROUP BY ALL
        """,
    ),
    "gold_revenue_by_hotel_year": _with(
        *_LAZY_SILVER, _GOLD_REVENUE, select="SELECT * FROM gold_revenue"
    ),
    "gold_top_countries": _with(
        *_LAZY_SILVER, _GOLD_COUNTRIES, select="SELECT * FROM gold_countries"
    ),
    "gold_room_performance": _with(*_LAZY_SILVER, _GOLD_ROOMS, select="SELECT * FROM gold_rooms"),
    "q1_revenue_trend": _with(*_LAZY_SILVER, _GOLD_REVENUE, select=_TREND),
    "q2_leading_countries": _with(
        *_LAZY_SILVER,
        _GOLD_COUNTRIES,
        select="""
        SELECT * FROM gold_countries
        ORDER BY total_revenue DESC, country_code NULLS FIRST, hotel_name NULLS FIRST
        LIMIT 10
        """,
    ),
    "q3_weekend_share": _with(
        *_LAZY_SILVER,
        _GOLD_ROOMS,
        select="""
        SELECT
            *,
            round(
                avg_weekend_nights / nullif(avg_weekend_nights + avg_weekday_nights, 0) * 100, 1
            ) AS pct_weekend_stays
        FROM gold_rooms
        """,
    ),
    "q4_quarterly_cancellations": _with(
        *_LAZY_SILVER,
        select=f"""
        SELECT
            year, quarter, hotel_name, country_code,
            count(booking_id) AS total_bookings,
            {_SUM_CANCELED} AS cancellations,
            {_CANCEL_PCT} AS cancel_pct,
            round(avg(lead_time), 0) AS avg_lead_time_days
        FROM silver
        WHERE year = 1996
            AND country_code IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
        GROUP BY year, quarter, hotel_name, country_code
        HAVING count(booking_id) >= 50
        """,
    ),
    "q5_monthly_bookings": _with(
        *_LAZY_SILVER,
        select=f"""
        SELECT
            year, month_number, month_name, hotel_name,
            count(booking_id) AS total_bookings,
            {_SUM_CANCELED} AS cancellations,
            round(avg(adr), 2) AS avg_daily_rate,
            round(sum(total_revenue), 2) AS total_revenue,
            round(avg(total_guests), 1) AS avg_party_size
        FROM silver
        GROUP BY year, month_number, month_name, hotel_name
        """,
    ),
    "table_registry": _with(
        *_LAZY_SILVER,
        _GOLD_REVENUE,
        _GOLD_COUNTRIES,
        _GOLD_ROOMS,
        select="""
        SELECT table_name, layer, "rows", CAST(NULL AS VARCHAR) AS error
        FROM (
            SELECT 'dim_date' AS table_name, 'DIM' AS layer, count(*) AS "rows" FROM calendar
            UNION ALL SELECT 'dim_hotel', 'DIM', count(*) FROM hotels
            UNION ALL SELECT 'dim_guest_origin', 'DIM', count(*) FROM origins
            UNION ALL SELECT 'dim_room_type', 'DIM', count(*) FROM rooms
            UNION ALL SELECT 'bronze_fact_bookings', 'BRONZE', count(*) FROM dated
            UNION ALL SELECT 'silver_fact_bookings_enriched', 'SILVER', count(*) FROM silver
            UNION ALL SELECT 'gold_revenue_by_hotel_year', 'GOLD', count(*) FROM gold_revenue
            UNION ALL SELECT 'gold_top_countries_revenue', 'GOLD', count(*) FROM gold_countries
            UNION ALL SELECT 'gold_room_type_performance', 'GOLD', count(*) FROM gold_rooms
        ) AS tables
        """,
    ),
    "stored_revenue_trend": _with(*_LAZY_SILVER, _GOLD_REVENUE, select=_TREND),
    "hotel_added_before_silver": _with(
        _FIXED,
        _BOOKINGS,
        select="""
        SELECT
            added, coalesce(hotel_key, 0) AS hotel_key, hotel_name, room_name,
            count(*) AS "rows", round(sum(total_revenue), 2) AS revenue
        FROM (
            SELECT
                reserved_room_type, total_revenue,
                CASE WHEN l_linenumber = 7 THEN 'Lisbon Boutique Hotel' ELSE hotel END AS booked
            FROM dated
        ) AS moved
        CROSS JOIN (VALUES (TRUE), (FALSE)) AS choice(added)
        LEFT JOIN (
            SELECT hotel_key, hotel_name FROM hotels
            UNION ALL SELECT 99, 'Lisbon Boutique Hotel'
        ) AS listed ON booked = hotel_name AND (added OR hotel_key <= 2)
        LEFT JOIN rooms ON reserved_room_type = room_code
        GROUP BY ALL
        """,
    ),
}

# The same results through numbering, the stream and stored tables.
ORACLE |= {
    f"stored_{name}": ORACLE[of]
    for name, of in {
        "top_countries": "gold_top_countries",
        "room_performance": "gold_room_performance",
        "leading_countries": "q2_leading_countries",
        "weekend_share": "q3_weekend_share",
        "quarterly_cancellations": "q4_quarterly_cancellations",
        "monthly_bookings": "q5_monthly_bookings",
    }.items()
}
ORACLE["gold_kept_up_revenue"] = ORACLE["gold_revenue_by_hotel_year"]
ORACLE["gold_kept_up_rooms"] = ORACLE["gold_room_performance"]
