"""Table writes: overwrite, append, keyed incremental load, yearly intervals, catalog."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Files that a task may have open at once when it writes a partitioned table.
OPEN_FILES = 64
# Bytes of a method above which the JVM does not compile it.
METHOD_BYTES = 8000
# How streamed tables and snapshots are compressed: a fifth smaller than by Spark's default.
CODEC = "zstd"
# A path that is not there, or a folder without data files.
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@contextmanager
def _set(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def open_files(spark: SparkSession, most: int = OPEN_FILES) -> AbstractContextManager[None]:
    """Within it, partitioned writes and batches of streams keep a file open for each partition.

    Otherwise Spark sorts the rows of every task by partition first, which spills them to disk
    where a task reads many rows from little input. Tasks with more partitions than files still do.
    """
    return _set(spark, "spark.sql.maxConcurrentOutputFileWriters", most)


def short_methods(spark: SparkSession, most: int = METHOD_BYTES) -> AbstractContextManager[None]:
    """Within it, Spark cuts what it generates for many columns into methods that the JVM compiles.

    Otherwise long ones are interpreted, row by row.
    """
    return _set(spark, "spark.sql.codegen.hugeMethodLimit", most)


def overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a table once and return it as stored: later actions do not rerun the plan."""
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Add rows to a table without looking at those it has."""
    df.write.format(fmt).mode("append").save(path)
    return df.sparkSession.read.format(fmt).load(path)


def unseen_rows(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """One row per key of the new rows whose key the stored table does not have.

    Of several new rows with one key the smallest is kept; NULL counts as a key.
    Only stored keys that also occur in the new rows take part in the anti join, so
    that its size follows the load and not the table.
    """
    rest = [c for c in new.columns if c != key]
    first = new.groupBy(key).agg(F.min(F.struct(*rest)).alias("_rest"))
    loaded = new.select(F.col(key).alias("_loaded"))
    known = (
        stored.select(F.col(key).alias("_known"))
        .join(loaded, F.col("_known").eqNullSafe(F.col("_loaded")), "left_semi")
        .distinct()
    )
    unseen = first.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    return unseen.select(
        *[F.col(c) if c == key else F.col(f"_rest.{c}").alias(c) for c in new.columns]
    )


def keyed_append(
    new: DataFrame, path: str, key: str, fmt: str = "parquet"
) -> DataFrame:
    """Append only rows with an unseen key: running the same load again adds nothing."""
    spark = new.sparkSession
    try:
        stored = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_TABLE:
            raise
        stored = spark.createDataFrame([], new.schema)
    return append(unseen_rows(new, stored, key), path, fmt)


def in_years(year: Column, years: Sequence[int | None]) -> Column:
    """Whether a year is one of those given; NULL is if None is given. Never NULL."""
    known = [y for y in years if y is not None]
    found = F.coalesce(year.isin(*known), F.lit(False)) if known else F.lit(False)
    return found | year.isNull() if None in years else found


def write_intervals(
    feed: DataFrame,
    path: str,
    years: Sequence[int | None] | None = None,
    mode: str = "append",
    max_records_per_file: int = 0,
    compression: str = "gzip",
) -> None:
    """Write the feed as JSON lines, one directory per arrival year, in one parallel pass.

    Lines are mostly the names of columns, so they are compressed. A compressed file is read by
    one task: each task that writes gives files of its own. The year is copied into the partition column because that column leaves the
    files. Appending lets intervals land one at a time.
    """
    if years is not None:
        feed = feed.filter(in_years(F.col("arrival_date_year"), years))
    with open_files(feed.sparkSession):
        (
            feed.withColumn("interval_year", F.col("arrival_date_year"))
            .write.mode(mode)
            .option("maxRecordsPerFile", max_records_per_file)
            .option("compression", compression)
            .partitionBy("interval_year")
            .json(path)
        )


def stored_or_none(
    spark: SparkSession, path: str, fmt: str, schema: str | StructType, **options: str
) -> DataFrame:
    """A table in the given schema; without rows where nothing is stored yet."""
    try:
        stored = spark.read.schema(schema).format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_TABLE:
            raise
        return spark.createDataFrame([], schema)
    return stored


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path has finished, by the marker that Spark leaves."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException as error:
        if error.getCondition() not in NO_TABLE:
            raise
        return False
    return True


def create_database(spark: SparkSession, database: str, path: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{path}'")


def register(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    partitioned: bool = False,
) -> DataFrame:
    """Give a stored table a catalog name; an existing name sees its newest files.

    A name whose columns are no longer the stored ones is given anew. The table is
    external: dropping the name leaves the files.
    """
    if spark.catalog.tableExists(name):
        stored = spark.read.format(fmt).load(path).schema
        listed = {(f.name, f.dataType) for f in spark.table(name).schema}
        if listed != {(f.name, f.dataType) for f in stored}:
            spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if partitioned and fmt == "parquet":
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
