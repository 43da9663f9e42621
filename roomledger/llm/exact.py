"""Exact dedup by content sort: equal normalised texts become neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import work_folder

# Copies of one text are dealt over this many ranges at least, so a hot text is no single task.
SPREAD = 16
# Characters of a text that splitters are sampled from, beside a digest.
PREFIX = 16


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed or carriage return is one space.

    NULL counts as empty. Single spaces, the common case, are left to the cheap translate.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     ")
    return F.regexp_replace(spaced, " {2,}", " ")


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Sampled splitters range partition the normalised texts, by their first PREFIX characters
    and a hash, so that no whole text is sampled to the driver. An external sort by these,
    text and id puts equal texts next to each other, and the comparison of neighbours (whole
    texts) ends each run; its first row has the smallest id. A text's copies are dealt over ranges by a
    hash of the id, as many as a shuffle has partitions and SPREAD at least; the runs of one
    text then meet by digest, without the text.

    NULL text is empty. A NULL id sorts after all others. Of rows that repeat both id and
    text one is kept. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    id_ = F.col(id_column).cast("bigint")
    spread = max(SPREAD, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        id_.alias("doc_id"),
        normalised(F.col(text_column)).alias("_norm"),
        F.pmod(F.xxhash64(id_), F.lit(spread)).cast("int").alias("_salt"),
    ).withColumns({"_prefix": F.substring("_norm", 1, PREFIX), "_hash": F.xxhash64("_norm")})
    order = [F.col("doc_id").asc_nulls_last()]
    place = ["_prefix", "_hash", "_salt"]
    run = Window.partitionBy(*place, "_norm").orderBy(*order)
    placed = (
        rows.repartitionByRange(*place)
        .withColumn("_place", F.row_number().over(run))
        .select("doc_id", F.sha2("_norm", 256).alias("text_sha256"), "_salt", "_place")
    )
    folder = work_folder(spark, "exact")
    placed.write.parquet(folder)
    placed = spark.read.parquet(folder)

    # A run's first row carries its smallest id; the largest place is the run's length.
    # Counts combine before the shuffle, so a hot text sends a row per task.
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_salt")
    # Stored, so that the join is one of two tables, whose hot digests are split at run time.
    placed.groupBy("text_sha256").agg(
        F.min(F.when(F.col("_place") == 1, first)).alias("_first"),
        F.count("*").alias("group_size"),
    ).write.parquet(f"{folder}-groups")
    groups = spark.read.parquet(f"{folder}-groups")
    stays = (F.col("_place") == 1) & (F.col("_salt") == F.col("_first._salt")) & F.col(
        "doc_id"
    ).eqNullSafe(F.col("_first.doc_id"))
    return placed.join(groups, "text_sha256").select(
        "doc_id",
        F.col("_first.doc_id").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: of equal rows all but one go.

    NULL id: such a row stays only if no other row has its text, once.
    """
    kept = exact_copies(docs, id_column, text_column).filter("kept")
    # The kept digests are unique, so the join keeps rows apart even if ids repeat.
    marked = docs.withColumn("_sha", F.sha2(normalised(F.col(text_column)), 256))
    wanted = kept.select(F.col("text_sha256").alias("_sha"), F.col("doc_id").alias("_kept_id"))
    found = marked.join(
        wanted,
        (marked["_sha"] == wanted["_sha"])
        & marked[id_column].cast("bigint").eqNullSafe(wanted["_kept_id"]),
    ).select(*[marked[c] for c in docs.columns], marked["_sha"].alias("_sha"))
    return found.dropDuplicates([id_column, "_sha"]).select(*docs.columns)
