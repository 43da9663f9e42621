"""Consecutive row numbers in a given order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# monotonically_increasing_id keeps the row's position in its partition in these bits.
_POSITION_BITS = 33
# Rows that a task may sort: some hundred bytes each, so that they fit its memory.
ROWS_PER_TASK = 1_000_000


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """Range partitions for so many rows; None where the session's own number is enough."""
    wanted = -(-rows // ROWS_PER_TASK)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str,
    folder: str,
    unique: bool = False,
    partitions: int | None = None,
    first: int = 1,
    keep: Sequence[str | Column] | None = None,
    codec: str = "zstd",
) -> DataFrame:
    """Add a bigint column counting 1..n in ascending order of the given columns or expressions.

    Equal to row_number() over the whole frame ordered the same way, NULL first.
    Rows that come later may go on from another first number.
    The rows are range partitioned and sorted on all order columns, so a hot leading
    value is spread by the columns after it. Each sorted partition is written with
    the positions of its rows; the number is the position plus the rows of all
    partitions before. The only unpartitioned window runs over one row per partition.

    Rows that are equal in every order column are told apart by their place in a
    first written copy of the frame, so that any number of copies spreads as well,
    and a task that runs again sees them in the same place. Set unique when no two
    rows are equal in the order columns: that copy is then left out.

    keep: the columns that come out beside the number, all unless given. Others that the order
    needs are shuffled, but not stored; those it does not need are not even shuffled. An expression is
    computed after the shuffle, from the columns that were.

    codec: how the stored sorted rows are compressed. folder: a fresh path on storage that all
    executors share.
    """
    spark = df.sparkSession
    keys = list(order_by)
    if not unique:
        landed = f"{folder}/landed"
        tied = df.withColumn("_tie", F.monotonically_increasing_id())
        tied.write.option("compression", "zstd").parquet(landed)
        df = spark.read.parquet(landed)
        keys.append("_tie")

    ranges = [(F.col(key) if isinstance(key, str) else key).asc_nulls_first() for key in keys]
    ranged = (
        df.repartitionByRange(partitions, *ranges)
        if partitions
        else df.repartitionByRange(*ranges)
    )
    place = F.monotonically_increasing_id()
    in_order = ranged.sortWithinPartitions(*ranges).drop("_tie")
    sorted_path = f"{folder}/sorted"
    (
        (in_order if keep is None else in_order.select(*keep))
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS).cast("int"))
        .write.option("compression", codec)
        .parquet(sorted_path)
    )
    placed = spark.read.parquet(sorted_path)

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    position = F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per range partition: at most as many as the shuffle has partitions.
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position + F.lit(first).cast("bigint"))
        .drop("_part", "_place", "_start")
    )
