"""All tables from their sources, stored and registered layer by layer."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roomledger import schemas
from roomledger.operators import checks, loads, marks
from roomledger.operators.lookup import Dimension
from roomledger.operators.snapshots import Snapshots, show_as
from roomledger.plans import dims, gold, gold_state, silver
from roomledger.plans.landing import land_feed, land_missing, landed_ids, withdrawn
from roomledger.streaming import bronze as bronze_stream
from roomledger.streaming import late
from roomledger.streaming import silver as silver_stream
from roomledger.streaming.bronze import BatchLimits

DIMENSIONS = ("dim_date", "dim_hotel", "dim_guest_origin", "dim_room_type")
BRONZE = "bronze_fact_bookings"
SILVER = "silver_fact_bookings_enriched"
STREAMED_SILVER = "silver_fact_bookings_streamed"
# Damaged lines of the landed files.
QUARANTINE = "bronze_refused_lines"
# Streamed facts without a member, and the same facts joined again.
PENDING = "silver_pending_bookings"
LATE_SILVER = "silver_late_bookings"
# What streamed Silver adds up to, batch by batch, and the merged batches.
GOLD_STATE = "gold_state_batches"
GOLD_BASE = "gold_state_merged"
GOLD = {
    "gold_revenue_by_hotel_year": gold.revenue_by_hotel_year,
    "gold_top_countries_revenue": gold.top_countries,
    "gold_room_type_performance": gold.room_performance,
}


# Tables that are rebuilt, each as a snapshot of its own.
REPLACED = (*DIMENSIONS, SILVER, LATE_SILVER, GOLD_BASE, *GOLD)


@dataclass(frozen=True)
class Lakehouse:
    """Where the tables live: paths below one folder, names in one database."""

    base: str
    database: str

    def path(self, name: str) -> str:
        """Where a table's rows are now: its newest snapshot, or the folder of its stream."""
        return self.paths((name,))[name]

    def paths(self, names: Sequence[str]) -> dict[str, str]:
        found = {}
        if any(name in REPLACED for name in names):
            found = self.snapshots.newest(SparkSession.active())
        return {name: found.get(name, f"{self.base}/{name.split('_', 1)[0]}/{name}") for name in names}

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(f"{self.base}/snapshots")

    def keys(self, name: str) -> str:
        """The registry of a dimension's surrogate keys."""
        return f"{self.base}/keys/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def table(self, name: str) -> str:
        return f"`{self.database}`.{name}"

    def staging(self, name: str) -> str:
        return f"{self.base}/staging/{name}-{uuid.uuid4().hex}"

    @property
    def intervals(self) -> str:
        return f"{self.base}/feed"

    @property
    def interval_files(self) -> str:
        """Intervals of numbered feeds, and those that were landed without one."""
        return f"{self.intervals}/{{interval_year=*,feed=*/interval_year=*}}"

    @property
    def manifest(self) -> str:
        return f"{self.base}/manifest"

    @property
    def digests(self) -> str:
        """Digests of the landed rows of named sources."""
        return f"{self.base}/digests"

    @property
    def withdrawn(self) -> str:
        return f"{self.base}/withdrawn"

    def tables(self) -> dict[str, str]:
        return self.paths((*DIMENSIONS, BRONZE, SILVER, *GOLD))

    def store(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table by its next snapshot; until that is whole, readers have the last one."""
        path = self.snapshots.replace(df, name, partition_by)
        show_as(df.sparkSession, self.table(name), path)
        return df.sparkSession.read.parquet(path)


def load_dimensions(
    spark: SparkSession,
    lake: Lakehouse,
    calendar: Dimension,
    hotels: DataFrame,
    room_types: DataFrame,
    profiles: DataFrame,
    last_hotel_key: int | None = None,
) -> silver.Dimensions:
    """Store the four dimensions; the stored tables are what Silver joins to."""
    lake.store(calendar.frame, "dim_date")
    lake.store(dims.hotels(hotels), "dim_hotel")
    lake.store(dims.room_types(room_types), "dim_room_type")
    origins = dims.lasting_guest_origins(
        profiles, lake.keys("dim_guest_origin"), lake.staging("guest_origins")
    )
    lake.store(origins, "dim_guest_origin")
    return stored_dimensions(spark, lake, last_hotel_key)


def stored_dimensions(
    spark: SparkSession, lake: Lakehouse, last_hotel_key: int | None = None
) -> silver.Dimensions:
    """The dimensions as stored; with last_hotel_key, without the hotels above it."""
    stored = lake.paths(DIMENSIONS)
    date, hotel, origin, room = (spark.read.parquet(stored[name]) for name in DIMENSIONS)
    if last_hotel_key is not None:
        hotel = silver.original_hotels(hotel, last_hotel_key)
    return silver.Dimensions(
        date=Dimension.counted(date),
        hotel=Dimension.counted(hotel),
        guest_origin=Dimension.counted(origin),
        room_type=Dimension.counted(room),
    )


def load_bronze(
    spark: SparkSession, lake: Lakehouse, limits: BatchLimits = BatchLimits()
) -> DataFrame:
    """Bring landed files into Bronze, and damaged lines of them into a table beside it.

    The Bronze stream counts damaged lines as it reads. Only if there are any are the files read
    for them; that stream has a checkpoint of its own, so a run that was lost in between is
    made up for by load_quarantine, which may be called at any time.
    """
    path = lake.path(BRONZE)
    query = bronze_stream.ingest(spark, lake.interval_files, path, lake.checkpoint(BRONZE), limits)
    if bronze_stream.saw_damage(query):
        load_quarantine(spark, lake, limits)
    loads.register(spark, lake.table(BRONZE), path)
    return bronze_stream.read_bronze(spark, path)


def load_quarantine(
    spark: SparkSession, lake: Lakehouse, limits: BatchLimits = BatchLimits()
) -> DataFrame:
    """Lines of landed files that could not be read whole, each once: see read_damaged."""
    path = lake.path(QUARANTINE)
    bronze_stream.quarantine(spark, lake.interval_files, path, lake.checkpoint(QUARANTINE), limits)
    return bronze_stream.read_quarantine(spark, path)


def load_bronze_by_interval(
    bookings: DataFrame,
    lake: Lakehouse,
    years: Sequence[int | None],
    limits: BatchLimits = BatchLimits(),
) -> DataFrame:
    """Land one year after the other, with a run of the stream after each.

    None is the interval of the bookings without a year. Bookings whose id has landed do
    not land again, so a year may be repeated. Without years Bronze stays as it is.
    """
    spark = bookings.sparkSession
    for year in years:
        known = landed_ids(spark, lake).filter(loads.in_years(F.col("interval_year"), [year]))
        own = bookings.filter(loads.in_years(F.col("arrival_date_year"), [year]))
        land_missing(own, known, f"{lake.intervals}/feed=intervals")
        load_bronze(spark, lake, limits)
    stored = loads.stored_or_none(spark, lake.path(BRONZE), "parquet", schemas.ddl(schemas.BRONZE))
    return stored.select(*schemas.BRONZE)


def standing_bronze(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """Bronze without the bookings that a later version of their source withdrew."""
    bronze = bronze_stream.read_bronze(spark, lake.path(BRONZE))
    gone = withdrawn(spark, lake).select("booking_id")
    if gone.isEmpty():
        return bronze
    return marks.among(bronze, "booking_id", gone, lake.staging("withdrawn"), without=True)


def load_silver(
    spark: SparkSession, lake: Lakehouse, dims: silver.Dimensions
) -> DataFrame:
    """Rebuild Silver from all of Bronze that stands, as is due after dimensions changed."""
    enriched = silver.enrich(standing_bronze(spark, lake), dims)
    return lake.store(enriched, SILVER, [silver_stream.PARTITION]).select(*schemas.SILVER)


def refresh_silver(
    spark: SparkSession,
    lake: Lakehouse,
    dims: silver.Dimensions,
    limits: BatchLimits = BatchLimits(),
) -> DataFrame:
    """Silver as a stream keeps it: only new Bronze rows are joined and added.

    A table beside the rebuilt one, with the keys its dimensions had at the time.
    """
    path = lake.path(STREAMED_SILVER)
    checkpoint = lake.checkpoint(STREAMED_SILVER)
    silver_stream.refresh(spark, lake.path(BRONZE), path, checkpoint, dims, limits)
    loads.register(spark, lake.table(STREAMED_SILVER), path)
    return silver_stream.read_silver(spark, path)


def resolve_late(
    spark: SparkSession,
    lake: Lakehouse,
    dims: silver.Dimensions,
    limits: BatchLimits = BatchLimits(),
) -> DataFrame:
    """Streamed Silver with every member the dimensions have by now, as is due after they grew.

    Facts that came without a member are pending: new ones are collected from the streamed
    table, and all of them are joined again, into the next snapshot of a table of their own.
    Its size follows the pending facts; other streamed rows are neither joined nor written.
    """
    paths = lake.paths((STREAMED_SILVER, PENDING))
    streamed = late.read_streamed(spark, paths[STREAMED_SILVER])
    late.collect_pending(
        spark, paths[STREAMED_SILVER], paths[PENDING], lake.checkpoint(PENDING), limits
    )
    schema = streamed.select(*late.PENDING).schema
    pending = late.read_pending(spark, paths[PENDING], schema)
    lake.store(late.joined_again(pending, dims), LATE_SILVER)
    return streamed_silver(spark, lake)


def streamed_silver(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """Streamed Silver, its late facts as they were last resolved."""
    paths = lake.paths((STREAMED_SILVER, LATE_SILVER))
    streamed = late.read_streamed(spark, paths[STREAMED_SILVER])
    schema = streamed.select(*schemas.SILVER).schema
    return late.with_late(streamed, loads.stored_or_none(spark, paths[LATE_SILVER], "parquet", schema))


def refresh_gold_state(
    spark: SparkSession, lake: Lakehouse, limits: BatchLimits = BatchLimits(), compact: bool = False
) -> DataFrame:
    """The state of Gold after the newly streamed Silver rows are added: see gold_state.

    Only new Silver rows are read. Facts that resolve_late joined again count as they are now:
    what they first counted is taken off, for as many facts as are pending. compact merges the
    batches so far into one table, which later states start from.
    """
    paths = lake.paths((STREAMED_SILVER, PENDING, LATE_SILVER, GOLD_STATE, GOLD_BASE))
    schema = late.read_streamed(spark, paths[STREAMED_SILVER]).schema
    gold_state.add_new_rows(
        spark, paths[STREAMED_SILVER], schema, paths[GOLD_STATE], lake.checkpoint(GOLD_STATE), limits
    )
    base = paths[GOLD_BASE] if GOLD_BASE in lake.snapshots.newest(spark) else None
    if compact:
        lake.snapshots.replace(gold_state.compacted(spark, paths[GOLD_STATE], base), GOLD_BASE)
        base = lake.path(GOLD_BASE)
    state = gold_state.read_state(spark, paths[GOLD_STATE], base)
    if LATE_SILVER not in lake.snapshots.newest(spark):
        return state
    joined = spark.read.parquet(paths[LATE_SILVER])
    pending = late.read_pending(
        spark, paths[PENDING], StructType([f for f in schema if f.name in late.PENDING])
    )
    first = late.first_counted(pending, joined)
    return gold_state.merged(
        state, gold_state.negated(gold_state.partials(first)), gold_state.partials(joined)
    )


def load_gold(stored_silver: DataFrame, lake: Lakehouse) -> dict[str, DataFrame]:
    return {name: lake.store(build(stored_silver), name) for name, build in GOLD.items()}


def build(
    spark: SparkSession,
    lake: Lakehouse,
    raw: DataFrame,
    hotels: DataFrame,
    room_types: DataFrame,
    profiles: DataFrame,
    calendar: Dimension | None = None,
    tie_breakers: Sequence[str] | None = None,
    unique: bool = False,
    last_hotel_key: int | None = None,
    limits: BatchLimits = BatchLimits(),
    source: str | None = None,
) -> DataFrame:
    """Build every table and return the registry. A source names the feed, see land_feed.

    The calendar covers the bookings' own dates unless one is given; a date that is not plausible
    does not widen it, see dims.stray_dates. Running it
    again after a failure goes on from the landed feed and the stream's checkpoint;
    dimensions, Silver and Gold are rebuilt.
    """
    loads.create_database(spark, lake.database, f"{lake.base}/catalog")
    land_feed(raw, lake, tie_breakers, unique, source)
    stored_bronze = load_bronze(spark, lake, limits)
    if calendar is None:
        bounds = dims.date_bounds(stored_bronze, within=dims.PLAUSIBLE)
        if bounds is None:
            raise ValueError("the feed has no arrival date to build a calendar from")
        calendar = dims.calendar(spark, *bounds)
    star = load_dimensions(
        spark, lake, calendar, hotels, room_types, profiles, last_hotel_key
    )
    load_gold(load_silver(spark, lake, star), lake)
    return checks.table_registry(spark, lake.tables())
