"""Facts whose dimension member comes later: kept as pending and joined again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from roomledger import schemas
from roomledger.operators import loads
from roomledger.plans.silver import UNKNOWN_KEY, Dimensions, enrich
from roomledger.streaming.bronze import BatchLimits, append_stream

# The columns a fact is joined by that Silver has not, kept beside it in the streamed table.
NATURAL = {"_hotel": "hotel", "_country": "country", "_room": "reserved_room_type"}
PENDING = (*schemas.SILVER, *NATURAL)
# The file of the pending table that a fact lies in, kept beside it once it is joined again.
ORIGIN = "_pending_file"


def unresolved() -> Column:
    """Whether a fact lacks a member that it names. A fact that names none stays as it is."""
    lost = [
        F.col(own).isNotNull() & (F.col(key) == UNKNOWN_KEY)
        for own, key in zip(NATURAL, ("hotel_key", "guest_origin_key", "room_type_key"))
    ]
    lost.append(F.col("date_key").isNotNull() & F.col("full_date").isNull())
    found = lost[0] | lost[1] | lost[2] | lost[3]
    return F.coalesce(found, F.lit(False)) & F.col("booking_id").isNotNull()


def read_streamed(spark: SparkSession, path: str) -> DataFrame:
    """Streamed Silver with the columns its facts were joined by."""
    found = spark.read.parquet(path).schema
    # The year is read from folder names, which tell no type where no fact has a date.
    fields = [StructField("year", IntegerType()) if f.name == "year" else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def collect_pending(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    limits: BatchLimits = BatchLimits(),
) -> StreamingQuery:
    """Add the unresolved facts among the streamed Silver rows not yet looked at.

    The stream follows Silver's own log, so every Silver file is read once, and a fact is pending
    exactly if Silver has it without a member, whatever the dimensions are by now.
    """
    schema = read_streamed(spark, silver_path).schema
    rows = spark.readStream.schema(schema).options(**limits.options()).parquet(silver_path)
    return append_stream(rows.filter(unresolved()).select(*PENDING), path, checkpoint)


def read_pending(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Pending facts, each with the name of its file. Files are added whole and never written again."""
    stored = loads.stored_or_none(spark, path, "parquet", schema)
    own = F.col("_metadata.file_name") if stored.inputFiles() else F.lit(None).cast("string")
    return stored.withColumn(ORIGIN, own)


def joined_again(pending: DataFrame, dims: Dimensions) -> DataFrame:
    """Pending facts with the members that the dimensions have now: Silver's columns, and the file."""
    keep = {ORIGIN: ORIGIN} if ORIGIN in pending.columns else {}
    facts = pending.select(
        *[F.col(own).alias(name) for own, name in NATURAL.items()],
        F.col("meal_plan").alias("meal"),
        F.col("special_requests").alias("total_of_special_requests"),
        *[c for c in schemas.SILVER if c in schemas.BRONZE],
        *keep,
    )
    return enrich(facts, dims, keep=keep)


def first_counted(pending: DataFrame, joined: DataFrame) -> DataFrame:
    """The pending facts that those joined again were made of, as they were before.

    They were made of whole files, so that names of files are compared, a row for each: no fact is
    shuffled, or sent to all tasks, for its id. Tables stored without the names are compared by id.
    """
    if ORIGIN not in joined.columns:
        return pending.join(joined.select("booking_id"), "booking_id", "left_semi")
    return pending.join(F.broadcast(joined.select(ORIGIN).distinct()), ORIGIN, "left_semi")


def with_late(streamed: DataFrame, joined: DataFrame) -> DataFrame:
    """Streamed Silver in which pending facts are as they were last joined.

    Only the streamed rows without a member are compared with the joined ones; all others
    pass without a shuffle.
    """
    known = joined.select(F.col("booking_id").alias("_again"))
    lacking = streamed.filter(unresolved())
    rest = lacking.join(known, F.col("booking_id") == F.col("_again"), "left_anti")
    parts = (streamed.filter(~unresolved()), rest, joined)
    whole, *others = [part.select(*schemas.SILVER) for part in parts]
    for other in others:
        whole = whole.unionByName(other)
    return whole
