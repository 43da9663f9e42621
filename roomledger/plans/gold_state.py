"""Gold kept up by state: counts and sums that new Silver rows are added to."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from roomledger.functions import measures as m
from roomledger.operators import loads
from roomledger.streaming.bronze import BatchLimits

# All that the Gold tables group or filter by. The state has a row for each combination.
GRAIN = (
    "hotel_name", "hotel_type", "year", "country_code", "room_name", "base_rate_tier", "is_canceled",
)
SUMMED = (
    "adr", "total_nights", "total_guests", "total_revenue", "stays_in_weekend_nights", "stays_in_week_nights",
)
ROWS, BOOKINGS, BATCH = "rows", "bookings", "_batch"


def _sums() -> list[str]:
    return [ROWS, BOOKINGS, *[f"{part}_{name}" for name in SUMMED for part in ("sum", "count")]]


def partials(silver: DataFrame) -> DataFrame:
    """Counts and sums of Silver rows, from which averages follow; they may be added up."""
    each = [
        column
        for name in SUMMED
        for column in (F.sum(name).cast("double").alias(f"sum_{name}"), F.count(name).alias(f"count_{name}"))
    ]
    return silver.groupBy(*GRAIN).agg(
        F.count("*").alias(ROWS), F.count("booking_id").alias(BOOKINGS), *each
    )


def negated(state: DataFrame) -> DataFrame:
    """What takes the rows behind some partials out of a state again."""
    return state.select(*GRAIN, *[(-F.col(name)).alias(name) for name in _sums()])


def merged(*states: DataFrame) -> DataFrame:
    """One state of several. Combinations that no row is left of are gone."""
    parts = [state.select(*GRAIN, *_sums()) for state in states]
    added = reduce(DataFrame.unionByName, parts).groupBy(*GRAIN).agg(
        *[F.sum(name).alias(name) for name in _sums()]
    )
    return added.filter(F.col(ROWS) > 0)


def add_new_rows(
    spark: SparkSession,
    silver_path: str,
    schema: object,
    path: str,
    checkpoint: str,
    limits: BatchLimits = BatchLimits(),
) -> StreamingQuery:
    """Add the partials of the Silver rows streamed since the last run.

    Each micro-batch is a folder of its own below path, which is written anew if the batch
    is repeated: no row counts twice, whatever fails in between. Silver rows of earlier runs are not read.
    """

    def write(batch: DataFrame, number: int) -> None:
        partials(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    rows = spark.readStream.schema(schema).options(**limits.options()).parquet(silver_path)
    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_state(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """The state of all batches: those of the base, a merged earlier state, and the later ones."""
    try:
        later = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in loads.NO_TABLE:
            raise
        raise ValueError(f"{path} has no state yet: add_new_rows first") from error
    if base is None:
        return merged(later)
    before = spark.read.parquet(base)
    last = before.agg(F.max(BATCH)).first()[0]
    return merged(before, later.filter(F.col(BATCH) > (-1 if last is None else last)))


def compacted(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """The state of all batches so far as one table, with the number of the last one."""
    last = spark.read.parquet(path).agg(F.max(BATCH)).first()[0]
    return read_state(spark, path, base).withColumn(BATCH, F.lit(last))


def _mean(name: str, digits: int) -> Column:
    return F.round(m.ratio(F.sum(f"sum_{name}"), F.sum(f"count_{name}")), digits)


def _bookings() -> Column:
    return F.sum(BOOKINGS).alias("total_bookings")


def _revenue() -> Column:
    return F.round(F.sum("sum_total_revenue"), 2).alias("total_revenue")


def _daily_rate() -> Column:
    return _mean("adr", 2).alias("avg_daily_rate")


def _stay_nights() -> Column:
    return _mean("total_nights", 1).alias("avg_stay_nights")


def revenue_by_hotel_year(state: DataFrame) -> DataFrame:
    """As gold.revenue_by_hotel_year of the rows behind the state."""
    canceled = F.sum(F.col("is_canceled") * F.col(ROWS))
    measures = (
        _bookings(),
        canceled.alias("total_cancellations"),
        m.percent(canceled, F.sum(BOOKINGS)).alias("cancel_pct"),
        _daily_rate(),
        _stay_nights(),
        _revenue(),
    )
    return state.groupBy("hotel_name", "hotel_type", "year").agg(*measures).orderBy("year", "hotel_name")


def top_countries(state: DataFrame, k: int = 15) -> DataFrame:
    """As gold.top_countries of the rows behind the state."""
    party = _mean("total_guests", 1).alias("avg_party_size")
    return (
        state.filter(F.col("is_canceled") == 0)
        .groupBy("country_code", "hotel_name")
        .agg(_bookings(), _stay_nights(), _daily_rate(), party, _revenue())
        .orderBy(F.desc("total_revenue"), "country_code", "hotel_name")
        .limit(k)
    )


def room_performance(state: DataFrame) -> DataFrame:
    """As gold.room_performance of the rows behind the state."""
    per_booking = F.round(m.ratio(F.sum("sum_total_revenue"), F.sum(BOOKINGS)), 2)
    return (
        state.filter(F.col("is_canceled") == 0)
        .groupBy("room_name", "base_rate_tier")
        .agg(
            _bookings(),
            _mean("stays_in_weekend_nights", 1).alias("avg_weekend_nights"),
            _mean("stays_in_week_nights", 1).alias("avg_weekday_nights"),
            _daily_rate(),
            _revenue(),
            per_booking.alias("revenue_per_booking"),
        )
        .orderBy(F.desc("total_revenue"), "room_name")
    )
