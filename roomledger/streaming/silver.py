"""The Silver stream: new Bronze rows joined to static dimensions and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from roomledger import schemas
from roomledger.operators import loads
from roomledger.operators.lookup import MAX_BROADCAST_ROWS, hot_keys
from roomledger.plans.silver import Dimensions, enrich
from roomledger.streaming.bronze import BatchLimits, append_stream, read_bronze, stream_bronze
from roomledger.streaming.late import NATURAL

PARTITION = "year"


def refresh(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    dims: Dimensions,
    limits: BatchLimits = BatchLimits(),
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> StreamingQuery:
    """Enrich the Bronze rows that Silver does not have yet; stored rows are not read.

    Beside Silver's columns the table keeps those that facts were joined by, for late members.

    The path is the stream's own: readers of it see what the sink's log lists, so a
    table written there as a batch would vanish and is refused.
    """
    if loads.is_complete(spark, path):
        raise ValueError(f"{path} was written as a batch; give the stream a path of its own")
    large = {
        own: dimension
        for own, dimension in (
            ("hotel", dims.hotel), ("country", dims.guest_origin), ("reserved_room_type", dims.room_type)
        )
        if dimension.rows > max_broadcast_rows
    }
    # A stream cannot split hot keys at run time: for a large dimension they are looked up before.
    hot = {own: hot_keys(read_bronze(spark, bronze_path), own) for own in large}
    facts = stream_bronze(spark, bronze_path, limits)
    enriched = enrich(facts, dims, max_broadcast_rows, NATURAL, hot)
    return append_stream(enriched, path, checkpoint, PARTITION)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*schemas.SILVER)
