"""Content-defined chunks as document fingerprints, and the likeness of two fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.rolling import mixed, splitmix

# Chunk sizes in bytes: none below SHORT or above LONG, most near USUAL.
SHORT, USUAL, LONG = 8, 32, 128
# A boundary needs these bits of the gear hash to be zero: harder before USUAL, easier after.
HARD, EASY = np.uint32(0xFC000000), np.uint32(0xE0000000)
GEAR = splitmix(np.arange(256, dtype="u8")).astype("u4")
BYTE = splitmix(np.arange(256, 512, dtype="u8"))
# Texts are hashed in pieces of this many bytes.
PIECE = 1 << 20
LOWEST = -(1 << 63)

SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, next_doc_id bigint"
)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the 32 bytes up to it: sum of GEAR[byte] << distance.

    The sum over 2m bytes is that over m bytes plus, shifted by m, that over the m before.
    """
    found = GEAR[data]
    for m in (1, 2, 4, 8, 16):
        found[m:] += found[:-m] << np.uint32(m) if len(found) > m else 0
    return found


def chunk_ends(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text's bytes; the last is its length."""
    n = len(data)
    hard, easy = [], []
    for start in range(0, n, PIECE):
        low = max(0, start - 31)
        found = gear_hashes(data[low : start + PIECE])[start - low :]
        hard.append(np.flatnonzero((found & HARD) == 0) + (start + 1))
        easy.append(np.flatnonzero((found & EASY) == 0) + (start + 1))
    if not n:
        return []
    hard, easy = np.append(np.concatenate(hard), n).tolist(), np.append(np.concatenate(easy), n).tolist()
    ends, at, h, e = [], 0, 0, 0
    while at < n:
        least, usual, most = at + SHORT, at + USUAL, at + LONG
        while h < len(hard) - 1 and hard[h] < least:
            h += 1
        end = hard[h]
        if end >= usual or end < least:
            while e < len(easy) - 1 and easy[e] < usual:
                e += 1
            end = min(easy[e], most) if easy[e] >= usual else n
        at = min(end, most, n)
        ends.append(at)
    return ends


def fingerprint(text: str) -> dict[int, int]:
    """Digest of each distinct chunk to its length in bytes, in order of appearance."""
    data = np.frombuffer(text.encode(), "u1")
    ends = np.array(chunk_ends(data), "i8")
    if not len(ends):
        return {}
    starts = np.append(0, ends[:-1])
    lengths = ends - starts
    # A chunk's digest is a polynomial in its bytes, no power above LONG.
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(BYTE[data] * POWERS[place], starts)
    digests = mixed(sums ^ lengths.astype("u8")) >> np.uint64(16)
    return dict(zip(digests.tolist(), lengths.tolist()))


POWERS = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15, "u8"))


def written(chunks: dict[int, int]) -> str:
    return ".".join(f"{digest:012x}{length:x}" for digest, length in chunks.items())


def likeness(one: dict[int, int], other: dict[int, int]) -> float:
    """Bytes in chunks of both, as a share of the larger set: the lesser containment.

    Two empty fingerprints are alike (1), an empty and another one are not (0).
    """
    if one == other:
        return 1.0
    most = max(sum(one.values()), sum(other.values()))
    if len(other) < len(one):
        one, other = other, one
    return sum(n for d, n in one.items() if d in other) / most


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def splitters(docs: DataFrame, buckets: int) -> list[int]:
    """Ids that part the documents into about equal ranges: at most one for each range."""
    shares = [k / buckets for k in range(1, buckets)]
    found = docs.approxQuantile("doc_id", shares, 0.25 / buckets) if shares else []
    return sorted({int(x) for x in found})


def fingerprints_beside_next(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", buckets: int | None = None
) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The next document has the next smaller id; after the smallest comes the largest. The
    edited text has its last third replaced by the start of the next one's.

    Ids are parted into ranges by sampled splitters. The largest id of each range is also
    sent to the range above, where the smallest id needs it: one row for each range, so no
    order over all rows is taken in one task, and texts are shuffled once and streamed.

    NULL text is empty, with the empty fingerprint. A NULL id counts as the smallest. Rows
    that repeat an id follow each other, ordered by text. A single document is followed by
    itself. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LOWEST)).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.col(id_column).isNull().alias("no_id"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 2 * parts
    edges = np.array(splitters(rows.select("doc_id"), buckets), "i8")

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right").astype("i4"))

    placed = rows.withColumn("bucket", bucket_of("doc_id"))
    # One row for each range: at most `buckets` of them.
    tops = placed.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    above = [(tops[k].top, tops[(k + 1) % len(tops)].bucket) for k in range(len(tops))]
    guests = spark.createDataFrame(above, "top bigint, above int")
    visiting = placed.join(F.broadcast(guests), F.col("doc_id") == F.col("top")).select(
        "doc_id", "text", "no_id", F.col("above").alias("bucket"), F.lit(True).alias("guest")
    )
    both = placed.withColumn("guest", F.lit(False)).unionByName(visiting)
    order = [F.col("bucket"), F.col("guest"), F.col("doc_id").desc(), F.col("text")]
    dealt = both.repartition(parts, "bucket").sortWithinPartitions(*order)
    return dealt.select("bucket", "guest", "doc_id", "no_id", "text").mapInArrow(_beside, SCHEMA)


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, a bucket's own first and its guest last: look one row ahead."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [{"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    held, out = None, []
    for batch in batches:
        for bucket, guest, doc, no_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            doc = None if no_id else doc
            own = (bucket, doc, text, fingerprint(text))
            if held and held[0] == bucket:
                out.append(_row(held, own))
            held = None if guest else own
            if len(out) >= 512:
                yield batch_of(out)
                out = []
    yield batch_of(out)


def _row(own: tuple, following: tuple) -> tuple:
    _, doc, text, chunks = own
    new = edited(text, following[2])
    new_chunks = chunks if new == text else fingerprint(new)
    return (
        doc, len(text), hashlib.sha256(new.encode()).hexdigest(), written(chunks), written(new_chunks),
        likeness(chunks, new_chunks), likeness(chunks, following[3]), following[1],
    )
