"""File readers with explicit types: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import schemas


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as text. A file whose header differs from the first one's fails."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _cast(name: str, kind: str) -> Column:
    """Text as a type, NULL if it does not fit; whole numbers may be written as 1.0."""
    text = F.col(name)
    if kind not in ("int", "bigint", "long"):
        return text.try_cast(kind)
    number = text.try_cast("double")
    whole = F.when(number == F.floor(number), number).try_cast(kind)
    return F.coalesce(text.try_cast(kind), whole)


def read_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The named columns of CSV files with a header, found by name and cast.

    Text that does not fit its type becomes NULL; `rejected_csv` counts it. All files of
    a path must have one header: another order of columns fails instead of mixing them up.
    Only the header is read to plan the scan, and only the named columns are parsed.
    """
    text = _csv_text(spark, path)
    return text.select(*[_cast(name, kind).alias(name) for name, kind in columns.items()])


def rejected_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """For each named column how many texts do not fit its type."""
    text = _csv_text(spark, path)
    lost = [
        F.count_if(F.col(name).isNotNull() & _cast(name, kind).isNull()).alias(name)
        for name, kind in columns.items()
    ]
    counts = text.agg(*lost)
    return counts.unpivot([], list(columns), "column", "rejected")


def read_bookings_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_BOOKING)


def read_hotels_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.HOTELS)


def read_room_types_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ROOM_TYPES)


DAMAGED = "_corrupt_record"


def _document_lines(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    schema = schemas.ddl({**columns, DAMAGED: "string"})
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", DAMAGED).json(path)


def _is_refused(columns: dict[str, str]) -> Column:
    """A damaged line that gave no value at all."""
    nothing = F.coalesce(*[F.col(name).cast("string") for name in columns]).isNull()
    return F.col(DAMAGED).isNotNull() & nothing


def read_documents(
    spark: SparkSession,
    path: str,
    columns: dict[str, str] = schemas.GUEST_PROFILE,
    drop: tuple[str, ...] = ("_id",),
) -> DataFrame:
    """A collection of JSON documents, one per line, without its internal id.

    A line that is no document gives no row, a value of another type gives NULL;
    `damaged_documents` has both.
    """
    lines = _document_lines(spark, path, columns)
    return lines.filter(~_is_refused(columns)).drop(DAMAGED, *drop)


def damaged_documents(
    spark: SparkSession, path: str, columns: dict[str, str] = schemas.GUEST_PROFILE
) -> DataFrame:
    """Lines that could not be read whole: line, parsed (as JSON), kept, _source_path."""
    return _document_lines(spark, path, columns).filter(F.col(DAMAGED).isNotNull()).select(
        F.col(DAMAGED).alias("line"),
        F.to_json(F.struct(*columns)).alias("parsed"),
        (~_is_refused(columns)).alias("kept"),
        F.col("_metadata.file_path").alias("_source_path"),
    )


def count_documents(documents: DataFrame) -> int:
    return documents.count()


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The yearly feed as a batch: the rows a stream over the same files would see."""
    return spark.read.schema(schemas.ddl(schemas.FEED)).json(path)


def rows(spark: SparkSession, values: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A small frame from literal rows."""
    return spark.createDataFrame(values, schemas.ddl(columns))
