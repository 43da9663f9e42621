"""Feeds of raw bookings, numbered and landed as yearly JSON intervals, known by their contents."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roomledger import schemas
from roomledger.operators import loads, marks
from roomledger.operators.codes import coded
from roomledger.operators.numbering import number_rows
from roomledger.plans import feed

if TYPE_CHECKING:
    from roomledger.plans.lakehouse import Lakehouse

MANIFEST = "feed string, first_id bigint, done boolean, source string"
LANDED = "booking_id bigint, feed string, interval_year int"
DIGEST = ("_first_half", "_second_half")
# Bits of a digest that are summed at once: a bigint holds such sums over 2^41 rows.
PIECE = 22
DIGESTS = "booking_id bigint, _first_half bigint, _second_half bigint, source string, feed string"
WITHDRAWN = "booking_id bigint, feed string"


def row_digest(rows: DataFrame) -> dict[str, Column]:
    """128 bits that two rows share only if they agree in every column by name, NULLs included.

    Each field is hashed with its name and whether it is NULL, in the order of the names, so
    neither the order of columns nor a value that moved to its neighbour's place goes unseen.
    Booking columns are hashed as their declared type, whatever reader they came from.
    """
    fields: list[Column] = []
    for name in sorted(rows.columns):
        kind = schemas.RAW_BOOKING.get(name)
        value = F.col(f"`{name}`")
        fields += [F.lit(name), value.isNull(), value.cast(kind) if kind else value]
    return {half: F.xxhash64(F.lit(seed), *fields) for seed, half in enumerate(DIGEST)}


def _contents() -> list[Column]:
    """The number of rows and the sums of their digests, each half in three pieces."""
    low, found = (1 << PIECE) - 1, [F.count("*").alias("rows")]
    for half in DIGEST:
        middle = F.shiftright(half, PIECE).bitwiseAND(low)
        pieces = (F.col(half).bitwiseAND(low), middle, F.shiftright(half, 2 * PIECE))
        found += [F.sum(piece).alias(f"{half}{k}") for k, piece in enumerate(pieces)]
    return found


def _name(found: dict[str, int | None]) -> str:
    """The name that stands for the contents of a feed, by its rows and the sums of both halves."""
    sums = [sum((found[f"{half}{k}"] or 0) << (k * PIECE) for k in range(3)) for half in DIGEST]
    return "-".join(f"{value & ((1 << 64) - 1):x}" for value in (found["rows"], *sums))


def staged(raw: DataFrame, folder: str, places: bool = True) -> tuple[DataFrame, str]:
    """A written copy of a feed with the place of each row, if asked for, and a name for its contents.

    The source is read once: the copy's writer counts the rows and adds up their digests. The
    name does not depend on the order of rows or columns. Digests compress badly, so they are
    not kept: they follow from the copy wherever they are needed.
    """
    seen = Observation()
    marked = raw.withColumns(row_digest(raw)).observe(seen, *_contents())
    return copied(marked.drop(*DIGEST), folder, places), _name(seen.get)


def copied(raw: DataFrame, folder: str, places: bool = True) -> DataFrame:
    """A written copy of a feed with the place of each row, if asked for."""
    copy = raw.withColumn("_place", F.monotonically_increasing_id()) if places else raw
    copy.write.option("compression", "zstd").parquet(folder)
    return raw.sparkSession.read.parquet(folder)


def named(raw: DataFrame) -> str:
    """The name of a feed's contents that staged gives it, without a copy."""
    return _name(raw.select(*[half.alias(name) for name, half in row_digest(raw).items()]).agg(*_contents()).first().asDict())


def landed_ids(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return loads.stored_or_none(
        spark, f"{lake.intervals}/feed=*", "json", LANDED, basePath=lake.intervals
    )


def land_missing(bookings: DataFrame, landed: DataFrame, path: str) -> None:
    """Add the bookings whose id has not landed. Files that are there are never touched."""
    if not landed.isEmpty():
        bookings = bookings.join(landed.select("booking_id"), "booking_id", "left_anti")
    loads.write_intervals(bookings.select(*schemas.FEED), path)


def known_rows(spark: SparkSession, lake: Lakehouse, source: str, but: str) -> DataFrame:
    """booking_id and digest of a source's landed rows that still stand, without one feed's."""
    landed = loads.stored_or_none(spark, f"{lake.digests}/feed=*", "parquet", DIGESTS, basePath=lake.digests)
    own = landed.filter((F.col("source") == source) & (F.col("feed") != but)).select("booking_id", *DIGEST)
    gone = withdrawn(spark, lake).filter(F.col("feed") != but)
    return own if gone.isEmpty() else marks.among(own, "booking_id", gone, lake.staging("withdrawn"), without=True)


def withdrawn(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """Ids of landed bookings that a later version of their source no longer has."""
    return loads.stored_or_none(spark, f"{lake.withdrawn}/feed=*", "parquet", WITHDRAWN, basePath=lake.withdrawn)


def changes(rows: DataFrame, known: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The rows that known ones lack, and the known ids that rows lack; both count copies.

    Copies are counted per digest before any shuffle, so a row that a third of the feed repeats
    is one row here; it is repeated again only as often as copies are missing. Only digests are
    compared, with the first place or id that has them, and only those that differ are written. Whole
    rows are not shuffled: the new ones are found by their places. Known ids are looked up by
    digest only where one has several.
    """
    spark = rows.sparkSession
    here = rows.select(*DIGEST, "_place", F.lit(None).cast("bigint").alias("_id"))
    there = known.select(*DIGEST, F.lit(None).cast("bigint").alias("_place"), F.col("booking_id").alias("_id"))
    both = here.unionByName(there).groupBy(*DIGEST).agg(
        F.struct(F.count("_place").alias("rows"), F.min("_place").alias("first")).alias("_here"),
        F.struct(F.count("_id").alias("rows"), F.min("_id").alias("first")).alias("_there"),
    )

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.option("compression", loads.CODEC).parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    compared = stored(both.filter("_here.rows != _there.rows"), "compared")
    more = compared.filter("_here.rows > _there.rows")
    columns = [c for c in rows.columns if c not in (*DIGEST, "_place")]
    picked = marks.among(rows, "_place", more.select(F.col("_here.first").alias("_place")), f"{folder}/places")
    # Written, so that Spark knows how few they are before it plans the joins to them.
    copies = more.select(*DIGEST, (F.col("_here.rows") - F.col("_there.rows")).alias("_more")).filter("_more > 1")
    new = picked.select(*DIGEST, *columns, F.lit(1).cast("bigint").alias("_place"))
    if not (copies := stored(copies, "more_copies")).isEmpty():
        many = F.sequence(F.lit(1).cast("bigint"), F.coalesce("_more", F.lit(1)))
        new = picked.join(copies, list(DIGEST), "left").select(*DIGEST, *columns, F.explode(many).alias("_place"))
    fewer = compared.filter("_here.rows < _there.rows")
    gone = fewer.filter("_there.rows = 1").select(F.col("_there.first").alias("booking_id"))
    several = fewer.filter("_there.rows > 1").select(*DIGEST, F.col("_here.rows").alias("_here"))
    if not (several := stored(several, "fewer_copies")).isEmpty():
        standing = known.join(several, list(DIGEST))
        # Of the copies the first ones stay; numbering them spreads a hot row over tasks.
        ranked = number_rows(
            standing, [*DIGEST, "booking_id"], "_rank", f"{folder}/copies", unique=True
        )
        ranked = stored(ranked, "ranked")
        least = stored(ranked.groupBy(*DIGEST).agg(F.min("_rank").alias("_least")), "least")
        last = ranked.join(least, list(DIGEST)).filter("_rank - _least >= _here")
        gone = gone.unionByName(last.select("booking_id"))
    return new, gone


def land_feed(
    raw: DataFrame,
    lake: Lakehouse,
    tie_breakers: Sequence[str] | None = None,
    unique: bool = False,
    source: str | None = None,
    stored: bool = False,
) -> None:
    """Number the bookings and land them as yearly JSON intervals.

    The lake's manifest lists feeds by their contents, with the first id each was given. A
    listed feed that is done is left alone. Another feed takes the ids after all landed
    ones. A feed that was cut short keeps its first id and lands what is missing: the
    stream may have read the rest. Until then no other feed may land. One driver lands at a time.

    Without a source every new feed is more bookings. With one, the feed is the newest version of
    that source: rows that an earlier version had, copy for copy, are not landed again, and
    landed rows that it lacks are withdrawn. So of a corrected feed only the changed rows land, with
    ids of their own, and a feed that comes back to an earlier version is compared anew.

    stored: the feed is cut from files that copied wrote and that stay as they are, with the places of
    its rows. It may then be read several times, and no copy of it is written.
    """
    with loads.short_methods(raw.sparkSession):
        _land_feed(raw, lake, tie_breakers, unique, source, stored)


def _land_feed(
    raw: DataFrame,
    lake: Lakehouse,
    tie_breakers: Sequence[str] | None,
    unique: bool,
    source: str | None,
    stored: bool,
) -> None:
    spark = raw.sparkSession
    folder = lake.staging("feed")
    if stored:
        rows, name = raw, named(raw.drop("_place"))
        raw = raw.drop("_place")
    else:
        rows, name = staged(raw, f"{folder}/raw", places=not unique or source is not None)
    listed = loads.stored_or_none(spark, lake.manifest, "json", MANIFEST)
    if source is not None:
        version = F.regexp_extract("feed", r"-v(\d+)$", 1).cast("int")
        done = listed.filter((F.col("source") == source) & F.col("done"))
        last = done.agg(F.max(F.struct(version.alias("version"), "feed")).alias("last")).first().last
        in_part = not _states(listed).filter(~F.col("done")).isEmpty()
        if last is not None and last.feed == f"{name}-v{last.version}" and not in_part:
            return
        name = f"{name}-v{0 if last is None else last.version + 1}"
    states = _states(listed)
    own = states.filter(F.col("feed") == name).first()
    if own and own.done:
        return
    landed = landed_ids(spark, lake)
    if own is None:
        if not states.filter(~F.col("done")).isEmpty():
            raise ValueError("a feed has landed in part; land it again before another one")
        first_id = (landed.agg(F.max("booking_id")).first()[0] or 0) + 1
        _note(spark, lake, name, first_id, False, source)
    else:
        first_id = own.first_id
    known = None if source is None else known_rows(spark, lake, source, name)
    # A source's first version is new as a whole: there is nothing to compare it with.
    count, whole = rows.count(), rows
    rows = rows.withColumns(row_digest(rows.drop("_place")))
    if known is not None and not known.isEmpty():
        rows, gone = changes(rows, known, f"{folder}/changes")
        gone.write.mode("overwrite").parquet(f"{lake.withdrawn}/feed={name}")
    if not unique:
        # Copies of a row are told apart by their place in the staged copy.
        tie_breakers = [*(tie_breakers or feed.tie_breakers()), *DIGEST, "_place"]
    ties = feed.tie_breakers() if tie_breakers is None else tie_breakers
    # What the feed does not list and no order needs is neither shuffled nor stored again. The
    # columns of a source stay, since the digests follow from them.
    dated = feed.with_arrival(rows)
    kept = {*feed.feed_sources(dated), *(raw.columns if source is not None else ())}
    kept = [c for c in dated.columns if c in kept]
    # Columns of few values are shuffled as some bits; they are stored as they were.
    ordered = ("arrival_date", "hotel", *ties)
    words, values = coded(whole, [c for c in kept if c in raw.columns and c not in ordered])
    dated = dated.select(*[c for c in dated.columns if c in {*kept, *ties} and c not in values], *words)
    ids = feed.numbered(
        dated, f"{folder}/numbered", ties, first_id, unique=True, rows=count,
        keep=[values.get(c, c) for c in kept],
    )
    if source is not None:
        digests = ids.select("booking_id", *row_digest(raw).values(), F.lit(source).alias("source"))
        digests = digests.toDF("booking_id", *DIGEST, "source")
        digests.write.mode("overwrite").option("compression", loads.CODEC).parquet(f"{lake.digests}/feed={name}")
    bookings = feed.measured(ids)
    own_landed = landed.filter(F.col("feed") == name)
    land_missing(feed.as_feed(bookings), own_landed, f"{lake.intervals}/feed={name}")
    _note(spark, lake, name, first_id, True, source)


def _states(listed: DataFrame) -> DataFrame:
    return listed.groupBy("feed").agg(F.max("first_id").alias("first_id"), F.max("done").alias("done"))


def _note(
    spark: SparkSession, lake: Lakehouse, name: str, first_id: int, done: bool, source: str | None
) -> None:
    row = spark.createDataFrame([(name, first_id, done, source)], MANIFEST)
    row.coalesce(1).write.mode("append").json(lake.manifest)
