"""Keyed MERGE into stored Parquet: only the partitions that hold changed keys are rewritten."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.operators import loads

# Keys are dealt over partitions named `number-of-all`, so a table knows how many it has.
BUCKET = "_bucket"
INSERTED, UPDATED, UNCHANGED, REFUSED = "inserted", "updated", "unchanged", "refused"


@dataclass(frozen=True)
class Merged:
    """How many keys a merge brought in, changed, left alone and refused."""

    inserted: int
    updated: int
    unchanged: int
    refused: int


def _bucket(key: str, buckets: int) -> Column:
    number = F.pmod(F.xxhash64(F.lit(key), F.col(key).isNull(), F.col(key)), F.lit(buckets))
    return F.concat(number.cast("string"), F.lit(f"-{buckets}"))


def _digest(columns: list[str]) -> Column:
    fields = [x for name in sorted(columns) for x in (F.col(name).isNull(), F.col(name))]
    return F.struct(F.xxhash64(F.lit(0), *fields).alias("a"), F.xxhash64(F.lit(1), *fields).alias("b"))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that is kept by merge."""
    return spark.read.parquet(path).drop(BUCKET)


def one_per_key(new: DataFrame, key: str) -> DataFrame:
    """One row per key with its values (_new), their digest, the rows it had, and whether they agree.

    Equal rows of a key count as one. Rows are combined before the shuffle, so a key that a
    third of the load repeats reaches its task as a few rows.
    """
    values = [c for c in new.columns if c != key]
    digest = _digest(values)
    return new.groupBy(key).agg(
        F.min(F.struct(digest.alias("d"), F.struct(*values).alias("v"))).alias("_least"),
        F.max(digest).alias("_most"),
        F.count("*").alias("_rows"),
    ).select(
        F.col(key).alias("_key"),
        F.col("_least.v").alias("_new"),
        F.col("_least.d").alias("_digest"),
        (F.col("_least.d") == F.col("_most")).alias("_agree"),
        "_rows",
    )


def merge(new: DataFrame, path: str, key: str, folder: str, buckets: int = 16) -> Merged:
    """Insert rows with an unseen key, replace the row of a known one, leave all other rows.

    new: the table's columns, in any order. Several different rows for one key say nothing certain:
    the key is refused, whatever the table has of it stays, and it is counted. NULL is a key.
    Rows that equal the stored ones change nothing.

    The table is partitioned by a hash of the key. Stored partitions are read only where the load
    has keys, and rewritten only where a row changes or comes in: files of all others stay as
    they are. The new partitions are first written whole below folder (a fresh path) and then put in
    place of the old ones, one by one; a merge that was cut short in between is completed by
    running it again. buckets counts for a new table; choose it so that one partition is a
    few hundred MB, since that is what one changed key rewrites at least.
    """
    spark = new.sparkSession
    try:
        stored = spark.read.parquet(path)
        first = stored.select(BUCKET).first()
        buckets = int(first[0].rsplit("-", 1)[1]) if first else buckets
    except AnalysisException as error:
        if error.getCondition() not in loads.NO_TABLE:
            raise
        stored = spark.createDataFrame([], new.schema).withColumn(BUCKET, F.lit(""))
    columns = [c for c in stored.columns if c != BUCKET]
    if sorted(columns) != sorted(new.columns):
        raise ValueError(f"the load has columns {new.columns}, the table {columns}")

    new = new.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in columns])
    asked = one_per_key(new, key)
    asked = asked.withColumn(BUCKET, _bucket("_key", buckets))
    asked.write.parquet(f"{folder}/asked")
    asked = spark.read.parquet(f"{folder}/asked")
    refused = asked.agg(F.count_if(~F.col("_agree"))).first()[0]
    wanted = asked.filter("_agree").drop("_agree", "_rows")

    # At most as many names as the table has partitions.
    touched = [row[0] for row in wanted.select(BUCKET).distinct().collect()]
    values = [c for c in columns if c != key]
    own = stored.filter(F.col(BUCKET).isin(touched)).select(
        F.col(key).alias("_own"), F.struct(*values).alias("_old"), _digest(values).alias("_was"),
        F.col(BUCKET).alias("_place"), F.lit(True).alias("_stored"),
    )
    both = own.join(
        wanted, (F.col("_place") == F.col(BUCKET)) & F.col("_own").eqNullSafe(F.col("_key")), "full"
    )
    asked_for, is_stored = F.col("_digest").isNotNull(), F.coalesce("_stored", F.lit(False))
    change = (
        F.when(asked_for & ~is_stored, INSERTED)
        .when(asked_for & (F.col("_was") != F.col("_digest")), UPDATED)
        .when(asked_for, UNCHANGED)
        .otherwise("kept")
    )
    row = F.when(asked_for, F.col("_new")).otherwise(F.col("_old"))
    merged = both.select(
        F.when(is_stored, F.col("_own")).otherwise(F.col("_key")).alias("_own"),
        row.alias("_row"),
        change.alias("_change"),
        F.coalesce("_place", BUCKET).alias(BUCKET),
    )
    merged.write.partitionBy(BUCKET).parquet(f"{folder}/merged")
    try:
        merged = spark.read.parquet(f"{folder}/merged")
    except AnalysisException as error:
        if error.getCondition() not in loads.NO_TABLE:
            raise
        return Merged(0, 0, 0, refused)
    found = merged.groupBy(BUCKET, "_change").agg(F.count("*").alias("rows")).collect()
    rewrite = {row[BUCKET] for row in found if row._change in (INSERTED, UPDATED)}
    if rewrite:
        rows = merged.filter(F.col(BUCKET).isin(*rewrite)).select(
            *[F.col("_own").alias(c) if c == key else F.col(f"_row.{c}").alias(c) for c in columns], BUCKET
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    count = {kind: sum(row.rows for row in found if row._change == kind) for kind in (INSERTED, UPDATED, UNCHANGED)}
    return Merged(**count, refused=refused)
