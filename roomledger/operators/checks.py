"""Row counts and key checks, each in one pass over its table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions.names import table_layer


def rows_by_source(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("_source_file").agg(F.count("*").alias("rows")).orderBy("_source_file")
    )


def row_count_check(df: DataFrame, expected: int | DataFrame) -> DataFrame:
    """Rows found beside rows expected, given as a number or as the frame to match."""
    none = F.lit(0).cast("bigint")
    found = df.agg(F.count("*").alias("rows")).withColumn("expected_rows", none)
    wanted = (
        expected.agg(F.count("*").alias("expected_rows"))
        if isinstance(expected, DataFrame)
        else df.sparkSession.range(1).select(F.lit(expected).cast("bigint").alias("expected_rows"))
    )
    both = found.unionByName(wanted.withColumn("rows", none))
    totals = both.agg(F.sum("rows").alias("rows"), F.sum("expected_rows").alias("expected_rows"))
    return totals.withColumn(
        "matches", (F.col("rows") == F.col("expected_rows")).cast("int")
    )


def unresolved_keys(silver: DataFrame) -> DataFrame:
    """How many facts found no row in each dimension.

    Surrogate keys are 0 there; the fact's own date key stays, so a missing
    calendar day shows as a NULL date.
    """
    return silver.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("hotel_key") == 0).alias("unknown_hotel"),
        F.count_if(F.col("guest_origin_key") == 0).alias("unknown_guest_origin"),
        F.count_if(F.col("room_type_key") == 0).alias("unknown_room_type"),
        F.count_if(F.col("full_date").isNull()).alias("unknown_date"),
    )


def null_keys(silver: DataFrame) -> DataFrame:
    """NULLs left in the four keys. The surrogate keys have none once 0 is filled in."""
    keys = ("hotel_key", "guest_origin_key", "room_type_key", "date_key")
    return silver.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(key).isNull()).alias(f"null_{key}") for key in keys],
    )


def dimension_counts(dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows of each dimension and how many of them repeat a join key.

    A join keeps the fact's row count only where no key repeats.
    """
    counts = []
    for name, (frame, key) in dimensions.items():
        copies = frame.groupBy(key).agg(F.count("*").alias("_n"))
        counts.append(
            copies.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_keys"),
            ).select(F.lit(name).alias("dimension"), "rows", "repeated_keys")
        )
    return reduce(DataFrame.unionByName, counts)


def table_registry(
    spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet"
) -> DataFrame:
    """Name, layer, row count and error text of stored tables, given as name to path.

    Tables are counted one by one, so that one that cannot be opened or read, for whatever
    reason, shows its error and no count, and the others still their rows.
    """
    entries = []
    for name, path in tables.items():
        try:
            entries.append((name, spark.read.format(fmt).load(path).count(), None))
        except Exception as problem:  # noqa: BLE001  any damage belongs into the list
            condition = getattr(problem, "getCondition", lambda: None)()
            entries.append((name, None, condition or f"{type(problem).__name__}: {problem}"[:500]))
    listed = spark.createDataFrame(entries, "table_name string, rows bigint, error string")
    return listed.select("table_name", table_layer(F.col("table_name")).alias("layer"), "rows", "error")
