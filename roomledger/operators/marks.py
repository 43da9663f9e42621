"""Rows by their numbers, found by one bit per number instead of a shuffle of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers per block: as many bits as bitmap_construct_agg holds, in 4 KB.
_BLOCK_BITS = 15
# Blocks that are broadcast, 64 MB. They hold half a billion numbers that lie close together.
MOST_BLOCKS = 16_384


def among(rows: DataFrame, number: str, wanted: DataFrame, folder: str, without: bool = False) -> DataFrame:
    """The rows whose number is wanted; with without, all others, those without a number too.

    rows are neither shuffled nor sorted: what goes to them is a bit for each number between wanted
    ones. wanted has the bigint column number, NULLs and repeats count for nothing; it may be of
    any size. Numbers so many or so far apart that their blocks pass MOST_BLOCKS are joined by shuffle.

    folder: a fresh path on storage that all executors share.
    """
    spark = rows.sparkSession
    wanted = wanted.select(number).filter(F.col(number).isNotNull())
    block, place = F.shiftright(number, _BLOCK_BITS), F.col(number).bitwiseAND((1 << _BLOCK_BITS) - 1)
    wanted.groupBy(block.alias("_block")).agg(
        F.bitmap_construct_agg(place).alias("_bits")
    ).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.parquet(folder)
    if blocks.count() > MOST_BLOCKS:
        return rows.join(wanted, number, "left_anti" if without else "left_semi").select(*rows.columns)
    found = rows.withColumn("_block", block).join(F.broadcast(blocks), "_block", "left" if without else "inner")
    marked = _bit(F.col("_bits"), place)
    kept = ~F.coalesce(marked, F.lit(False)) if without else marked
    return found.filter(kept).select(*rows.columns)


def _bit(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), place.bitwiseAND(7).cast("int")) == 1
