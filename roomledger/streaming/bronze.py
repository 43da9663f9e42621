"""The Bronze stream: each landed JSON file once, with lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from roomledger import schemas
from roomledger.functions.names import source_file
from roomledger.operators import loads

# Bronze is stored by arrival year, so that a year's readers skip the others.
PARTITION = "arrival_date_year"
# The file source skips files this much older than the newest one it saw; the default of a
# week would lose copies that keep their times. Far above any backlog.
MAX_FILE_AGE = "36500d"


# The column that takes the text of a damaged line, and the name its counts are noted under.
DAMAGED = "_corrupt_record"
LINES = "lines"
REFUSED = "line string, parsed string, kept boolean, _source_path string, _ingest_timestamp timestamp"
# Micro-batches whose progress a query remembers, by Spark's default.
MOST_PROGRESS = 100


@dataclass(frozen=True)
class BatchLimits:
    """How much a micro-batch takes at most; without limits, all that has landed."""

    files: int | None = None
    bytes: str | None = None

    def options(self) -> dict[str, str]:
        chosen = {"maxFilesPerTrigger": self.files, "maxBytesPerTrigger": self.bytes}
        limits = {name: str(value) for name, value in chosen.items() if value is not None}
        return {"maxFileAge": MAX_FILE_AGE, **limits}


def _lines(spark: SparkSession, files: str, limits: BatchLimits) -> DataFrame:
    """The feed's lines with their text where a line could not be read whole."""
    schema = schemas.ddl({**schemas.FEED, DAMAGED: "string"})
    reader = spark.readStream.schema(schema).options(**limits.options())
    return reader.option("columnNameOfCorruptRecord", DAMAGED).json(files)


def is_refused() -> Column:
    """A damaged line of which not even the booking's id could be read."""
    return F.col(DAMAGED).isNotNull() & F.col("booking_id").isNull()


def read_intervals(
    spark: SparkSession, files: str, limits: BatchLimits = BatchLimits()
) -> DataFrame:
    """A stream of the feed files under a path or glob, in the fixed feed schema.

    A line that is no JSON, or is cut off, gives no row; a value of another type gives NULL in
    its column. Both are counted with the progress of the query, under LINES.
    """
    lines = _lines(spark, files, limits)
    counted = lines.observe(
        LINES,
        F.count("*").alias("read"),
        F.count_if(F.col(DAMAGED).isNotNull()).alias("damaged"),
        F.count_if(is_refused()).alias("refused"),
    )
    return counted.filter(~is_refused()).drop(DAMAGED)


def read_damaged(
    spark: SparkSession, files: str, limits: BatchLimits = BatchLimits()
) -> DataFrame:
    """A stream of the lines that could not be read whole.

    line: its text; parsed: what could be read, as JSON; kept: whether that is a row of Bronze;
    _source_path: the file; _ingest_timestamp: one per micro-batch.
    """
    return _lines(spark, files, limits).filter(F.col(DAMAGED).isNotNull()).select(
        F.col(DAMAGED).alias("line"),
        F.to_json(F.struct(*schemas.FEED)).alias("parsed"),
        (~is_refused()).alias("kept"),
        F.col("_metadata.file_path").alias("_source_path"),
        F.current_timestamp().alias("_ingest_timestamp"),
    )


def with_lineage(feed: DataFrame) -> DataFrame:
    """Add the ingest time, one per micro-batch, and the feed file a row came from."""
    return feed.select(
        "*",
        F.current_timestamp().alias("_ingest_timestamp"),
        source_file(F.col("_metadata.file_path")).alias("_source_file"),
    )


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, partition_by: str | None = None
) -> StreamingQuery:
    """Append all that is available to Parquet files, and return when that is done.

    The checkpoint and the sink's own log let every source file through once,
    whatever fails in between; both must live as long as the table.
    """
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", loads.CODEC)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    # The sink looks the setting up batch by batch, so it holds until the last one.
    with loads.open_files(rows.sparkSession):
        query = writer.start(path)
        query.awaitTermination()
    return query


def ingest(
    spark: SparkSession,
    files: str,
    path: str,
    checkpoint: str,
    limits: BatchLimits = BatchLimits(),
) -> StreamingQuery:
    """Bring all landed and not yet seen files into Bronze. Run once per interval."""
    stream = with_lineage(read_intervals(spark, files, limits))
    return append_stream(stream, path, checkpoint, PARTITION)


def counted_lines(query: StreamingQuery) -> dict[str, int]:
    """Lines read, damaged and refused by a run, from its progress: nothing is scanned for it."""
    found = [dict(p.observedMetrics).get(LINES) for p in query.recentProgress]
    return {
        name: sum(row[name] for row in found if row is not None)
        for name in ("read", "damaged", "refused")
    }


def saw_damage(query: StreamingQuery) -> bool:
    """Whether a run may have read damaged lines. Long runs drop the progress of early batches."""
    return counted_lines(query)["damaged"] > 0 or len(query.recentProgress) >= MOST_PROGRESS


def quarantine(
    spark: SparkSession,
    files: str,
    path: str,
    checkpoint: str,
    limits: BatchLimits = BatchLimits(),
) -> StreamingQuery:
    """Set aside the damaged lines of all files that this was not yet done for."""
    return append_stream(read_damaged(spark, files, limits), path, checkpoint)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return loads.stored_or_none(spark, path, "parquet", REFUSED)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze as a table, in the order of its columns."""
    stored = spark.read.schema(schemas.ddl(schemas.BRONZE)).parquet(path)
    return stored.select(*schemas.BRONZE)


def stream_bronze(
    spark: SparkSession, path: str, limits: BatchLimits = BatchLimits()
) -> DataFrame:
    """Bronze as a stream: the rows appended since the reader's last run."""
    reader = spark.readStream.schema(schemas.ddl(schemas.BRONZE)).options(**limits.options())
    return reader.parquet(path).select(*schemas.BRONZE)
