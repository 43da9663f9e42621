"""Gold by state, calendars that stray dates do not widen, and hot keys on a stream."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roomledger.operators import loads, lookup
from roomledger.operators.lookup import Dimension
from roomledger.plans import dims, gold, gold_state, lakehouse, silver
from roomledger.session import work_folder
from roomledger.streaming import bronze, late
from roomledger.streaming import silver as silver_stream
from tests.test_quarantine import grown
from tests.test_streaming import dimensions, feed, table


@pytest.fixture
def lake(spark):
    lake = lakehouse.Lakehouse(work_folder(spark, "test"), "db_" + uuid.uuid4().hex)
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    return lake


PAIRS = (
    (gold_state.revenue_by_hotel_year, gold.revenue_by_hotel_year),
    (gold_state.top_countries, gold.top_countries),
    (gold_state.room_performance, gold.room_performance),
)


def bookings(spark, first, rows, year):
    odd = feed(spark, first, rows, year)
    return odd.withColumns({
        "is_canceled": F.when(F.col("booking_id") % 5 != 0, (F.col("booking_id") % 2).cast("int")),
        "adr": F.when(F.col("booking_id") % 7 != 0, F.col("booking_id") * 1.37),
        "total_revenue": F.when(F.col("booking_id") % 4 != 0, F.col("booking_id") * 2.11),
        "total_nights": (F.col("booking_id") % 6).cast("int"),
        "total_guests": (F.col("booking_id") % 3).cast("int"),
        "stays_in_weekend_nights": (F.col("booking_id") % 2).cast("int"),
    })


def load(spark, lake, rows, known):
    loads.write_intervals(rows, lake.intervals)
    lakehouse.load_bronze(spark, lake)
    lakehouse.refresh_silver(spark, lake, known)


def test_state_equals_rebuilt_gold_after_each_interval(spark, lake):
    known = dimensions(spark)
    for k, year in enumerate((2015, 2016, 2017)):
        load(spark, lake, bookings(spark, k * 100, 40 + k, year), known)
        state = lakehouse.refresh_gold_state(spark, lake, compact=k == 1)
        whole = lakehouse.streamed_silver(spark, lake)
        for kept_up, rebuilt in PAIRS:
            assert table(kept_up(state)) == table(rebuilt(whole))
    again = lakehouse.refresh_gold_state(spark, lake)
    assert again.agg(F.sum("rows")).first()[0] == 40 + 41 + 42


def test_only_new_silver_rows_are_read(spark, lake):
    known = dimensions(spark)
    path, checkpoint = lake.path(lakehouse.GOLD_STATE), lake.checkpoint(lakehouse.GOLD_STATE)
    for k, rows in enumerate((30, 7)):
        load(spark, lake, bookings(spark, k * 100, rows, 2015 + k), known)
        silver_path = lake.path(lakehouse.STREAMED_SILVER)
        schema = late.read_streamed(spark, silver_path).schema
        query = gold_state.add_new_rows(spark, silver_path, schema, path, checkpoint)
        assert sum(p["numInputRows"] for p in query.recentProgress) == rows
    files = gold_state.read_state(spark, path).inputFiles()
    assert files and all("gold_state_batches" in file for file in files)


def test_a_repeated_batch_counts_once(spark, lake):
    known = dimensions(spark)
    load(spark, lake, bookings(spark, 0, 30, 2015), known)
    lakehouse.refresh_gold_state(spark, lake)
    commits = Path(lake.checkpoint(lakehouse.GOLD_STATE)) / "commits"
    for file in commits.glob("*0*"):
        file.unlink()
    state = lakehouse.refresh_gold_state(spark, lake)
    assert state.agg(F.sum("rows")).first()[0] == 30


def test_late_members_move_between_groups(spark, lake):
    before, after = dimensions(spark), grown(spark, dimensions(spark))
    load(spark, lake, bookings(spark, 0, 30, 2015), before)
    lakehouse.resolve_late(spark, lake, before)
    lakehouse.refresh_gold_state(spark, lake)
    load(spark, lake, bookings(spark, 100, 21, 2016), after)
    whole = lakehouse.resolve_late(spark, lake, after)
    for compact in (False, True, False):
        state = lakehouse.refresh_gold_state(spark, lake, compact=compact)
        assert state.filter("hotel_name IS NULL").count() == 0
        for kept_up, rebuilt in PAIRS:
            assert table(kept_up(state)) == table(rebuilt(whole))


def test_facts_joined_again_are_not_compared_by_id(spark, lake):
    before, after = dimensions(spark), grown(spark, dimensions(spark))
    load(spark, lake, bookings(spark, 0, 30, 2015), before)
    lakehouse.resolve_late(spark, lake, before)
    whole = lakehouse.resolve_late(spark, lake, after)
    state = lakehouse.refresh_gold_state(spark, lake)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi, (booking_id" not in plan and "Join LeftSemi, (_pending_file" in plan
    for kept_up, rebuilt in PAIRS:
        assert table(kept_up(state)) == table(rebuilt(whole))


def test_facts_that_were_not_joined_again_stay_counted(spark, lake):
    """Pending facts that came after the last resolving, under ids that occurred before."""
    known = dimensions(spark)
    for year in (2015, 2016):
        load(spark, lake, bookings(spark, 0, 30, year), known)
        if year == 2015:
            lakehouse.resolve_late(spark, lake, known)
    paths = lake.paths((lakehouse.STREAMED_SILVER, lakehouse.PENDING))
    late.collect_pending(spark, *paths.values(), lake.checkpoint(lakehouse.PENDING))
    state = lakehouse.refresh_gold_state(spark, lake)
    assert state.agg(F.sum("rows")).first()[0] == 60


def test_a_late_table_without_files_is_compared_by_id(spark, lake):
    before, after = dimensions(spark), grown(spark, dimensions(spark))
    load(spark, lake, bookings(spark, 0, 30, 2015), before)
    lakehouse.resolve_late(spark, lake, before)
    whole = lakehouse.resolve_late(spark, lake, after)
    stored = spark.read.parquet(lake.path(lakehouse.LATE_SILVER)).drop(late.ORIGIN)
    lake.store(stored, lakehouse.LATE_SILVER)
    state = lakehouse.refresh_gold_state(spark, lake)
    for kept_up, rebuilt in PAIRS:
        assert table(kept_up(state)) == table(rebuilt(whole))


# Calendar.

def test_a_stray_year_does_not_widen_the_calendar(spark):
    days = spark.createDataFrame(
        [(d,) for d in ("2015-01-01", "2015-03-01", "9999-12-31", "0001-01-01", "2015-01-01", "no date", None)],
        "arrival_date string",
    )
    bounds = dims.date_bounds(days, within=dims.PLAUSIBLE)
    assert bounds == (dt.date(2015, 1, 1), dt.date(2015, 3, 1))
    calendar = dims.calendar(spark, *bounds)
    assert calendar.rows == calendar.frame.count() == 60
    stray = dims.stray_dates(days).collect()
    assert [(r.full_date.year, r.rows) for r in stray] == [(1, 1), (9999, 1)]
    assert dims.date_bounds(days.filter("arrival_date > '9'"), within=dims.PLAUSIBLE) is None


def test_a_long_calendar_is_made_by_several_tasks(spark):
    calendar = dims.calendar(spark, dt.date(1500, 1, 1), dt.date(2100, 1, 1))
    assert calendar.frame.rdd.getNumPartitions() == 3
    first, last, n = calendar.frame.agg(F.min("full_date"), F.max("full_date"), F.count_distinct("date_key")).first()
    assert (first, last, n) == (dt.date(1500, 1, 1), dt.date(2100, 1, 1), calendar.rows)


def test_silver_still_broadcasts_the_calendar(spark):
    facts = feed(spark, 0, 6, 2015).select("*", F.current_timestamp().alias("_ingest_timestamp"), F.lit("").alias("_source_file"))
    stray = facts.withColumn("arrival_date", F.lit("9999-12-31"))
    both = facts.withColumn("arrival_date", F.lit("2015-01-01")).unionByName(stray)
    calendar = dims.calendar(spark, *dims.date_bounds(both, within=dims.PLAUSIBLE))
    known = dimensions(spark)
    star = silver.Dimensions(calendar, known.hotel, known.guest_origin, known.room_type)
    plan = silver.enrich(both, star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4 and calendar.rows == 1


# Hot keys of a large dimension.

def test_hot_keys_are_found(spark):
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, 'hot', if(id % 10 = 1, 'warm', concat('k', id))) as k")
    assert set(lookup.hot_keys(rows, "k", share=0.05)) == {"hot", "warm"}
    assert lookup.hot_keys(rows.filter("k is null"), "k") == []


def test_dealt_lookup_gives_the_same_rows(spark):
    fact = spark.range(3000).selectExpr(
        "id", "case when id % 2 = 0 then 7 when id % 5 = 0 then null when id % 7 = 0 then -1 else id % 50 end as key"
    )
    members = spark.range(40).selectExpr("id as dim_key", "concat('m', id) as name")
    plain = lookup.lookup(fact, Dimension(members, 40), F.col("key") == F.col("dim_key"))
    for hot in ([], [7], [7, 3, 999]):
        dealt = lookup.lookup_dealt(fact, members, "key", "dim_key", hot, "id")
        assert dealt.columns == plain.columns and table(dealt) == table(plain)


def test_a_hot_key_on_a_stream_is_dealt_over_tasks(spark, lake):
    """Half the rows on one country: the largest task of the join has at most three times the median."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = feed(spark, 0, 8000, 2015).withColumn(
            "country", F.when(F.col("booking_id") % 2 == 0, "PRT").otherwise(F.concat(F.lit("C"), F.col("booking_id")))
        )
        members = spark.range(8000).selectExpr("int(id + 1) as guest_origin_key", "if(id = 0, 'PRT', concat('C', id)) as country_code")
        known = dimensions(spark)
        star = silver.Dimensions(known.date, known.hotel, Dimension.counted(members), known.room_type)
        loads.write_intervals(hot, lake.intervals)
        lakehouse.load_bronze(spark, lake)
        facts = bronze.read_bronze(spark, lake.path(lakehouse.BRONZE))
        found = {"country": lookup.hot_keys(facts, "country")}
        assert found == {"country": ["PRT"]}

        def largest(own):
            parts = silver.enrich(facts, star, 100, hot=own).groupBy(F.spark_partition_id()).count().collect()
            sizes = sorted(r["count"] for r in parts)
            return sizes[-1] / sizes[len(sizes) // 2]

        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert largest({}) > 1.5 * largest(found) and largest(found) <= 3
        path = lake.path("silver_dealt")
        silver_stream.refresh(spark, lake.path(lakehouse.BRONZE), path, lake.checkpoint("d"), star, max_broadcast_rows=100)
        streamed = silver_stream.read_silver(spark, path)
        assert table(streamed) == table(silver.enrich(facts, star)) and streamed.count() == 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
