"""Near-duplicate documents: MinHash bands, exact verification, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.components import components
from roomledger.llm.rolling import grams, joined, mixed, splitmix, together, words
from roomledger.llm.sift import sifted
from roomledger.session import work_folder

ROWS = 5
# A link at the least similarity is missed by all bands once in a million.
MISSED = 1e-6
# Members of a bucket that are compared at once.
BLOCK = 1024
# Shingles hashed at once.
PIECE = 4096
# Bits of an odd sketch, a power of two.
ODD_BITS = 2048
LAST = (1 << 63) - 1


def bands_for(similarity: float, rows: int = ROWS) -> int:
    """The fewest bands of some rows that miss a pair this similar once in a million."""
    return int(np.ceil(np.log(MISSED) / np.log1p(-(similarity**rows))))


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z folded.

    A text with fewer words than a shingle has its whole sequence as one.
    """
    data, starts = joined([t.encode() for t in texts])
    found = words(data, lower=True)
    edges = np.searchsorted(found.starts, starts)
    runs = grams(found.hashes, size)
    for low, high in zip(edges.tolist(), edges[1:].tolist()):
        n = high - low
        if n >= size:
            yield np.unique(runs[low : high - size + 1])
        else:
            yield mixed(grams(found.hashes[low:high], max(n, 1)) + np.uint64(n))


class Minima:
    """The minima of many universal hash functions x -> (a x + b) mod 2^64, a odd."""

    def __init__(self, count: int) -> None:
        numbers = splitmix(np.arange(5000, 5000 + 2 * count, dtype="u8"))
        self.a, self.b = numbers[:count, None] | np.uint64(1), numbers[count:, None]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo("u8").max, "u8")
        for at in range(0, len(shingles), PIECE):
            values = self.a * shingles[None, at : at + PIECE]
            values += self.b
            np.minimum(least, values.min(axis=1), out=least)
        return least


def odd_sketch(shingles: np.ndarray) -> bytes:
    """For each of ODD_BITS groups of hashes, whether a set has an odd number of them.

    Two sketches differ in at most as many bits as the sets have elements not in common, so
    they rule pairs out for certain, and nearly all of them where sets are small.
    """
    group = (shingles >> np.uint64(65 - ODD_BITS.bit_length())).astype("i8")
    return np.packbits(np.bincount(group, minlength=ODD_BITS) & 1 == 1).tobytes()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_id.

    Documents are linked whose sets of `shingle` words have a Jaccard similarity of percent
    or more; component_id is the smallest doc_id reachable by links, and the row with that
    id is kept. class_id is the smallest doc_id with an equal set.

    Documents with equal sets form one class, and one member stands for it. MinHash bands
    put classes into buckets. First every class is compared with the smallest of each of
    its buckets; links are confirmed on the full sets, and components are taken. Then the
    classes of a bucket that are still in different components are compared by odd sketch
    and signature, in blocks, and those within reach are confirmed on the full sets too. So no pair of
    one component is compared again, and no link between two components of a bucket is lost.

    NULL or blank text has an empty set, which is linked with nothing, not even its like.
    A row without id cannot be named by a link: it stays alone, with a NULL component.
    Rows that repeat an id share a component. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "near")
    bands = bands_for(percent / 100)
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST)).alias("id"),
        F.col(text_column).cast("string").alias("text"),
    )

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    sketch = stored(
        rows.mapInArrow(_sketches(shingle, bands), "id bigint, n bigint, digest binary, sig binary, odd binary, keys array<bigint>"),
        "sketch",
    )
    named = F.col("id") < LAST
    # Stored, so that the join is one of two tables, whose hot digests are split at run time.
    classes = stored(
        sketch.filter((F.col("n") > 0) & named).groupBy("digest").agg(F.min("id").alias("class_id")), "least"
    )
    own = sketch.select("id", "n", "digest").join(classes, "digest", "left")
    all_rows = stored(
        own.select("id", "n", F.when(named, F.coalesce("class_id", "id")).otherwise(F.col("id")).alias("class_id"), (named & F.col("class_id").isNotNull()).alias("linked")),
        "classes",
    )

    stands = all_rows.filter("linked and id = class_id").select("id").distinct()
    keys = sketch.select("id", F.explode("keys").alias("band")).join(stands, "id", "left_semi").distinct()
    buckets = keys.groupBy("band").agg(F.count("*").alias("size"), F.min("id").alias("least"))
    members = stored(keys.join(buckets.filter("size > 1"), "band"), "members")

    candidates = members.select("id").distinct()
    wanted = sifted(rows, "id", candidates).join(candidates, "id", "left_semi")
    # An id with several texts has several sets, each of which may make a link.
    own_sets = wanted.mapInArrow(_sets(shingle), "id bigint, digest binary, shingles binary")
    sets = stored(own_sets.filter("octet_length(shingles) > 0").dropDuplicates(["id", "digest"]).drop("digest"), "sets")

    star = members.filter("id > least").select(F.col("least").alias("u"), F.col("id").alias("v")).distinct()
    links = stored(_confirmed(star, sets, percent), "star")
    labels = stored(components(links), "labels")

    # Where a bucket still holds several components, its members are compared across them.
    labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    open_bands = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("band")
    )
    signatures = (
        sketch.filter("n > 0").select("id", "n", "digest", "sig", "odd")
        .join(candidates, "id", "left_semi").dropDuplicates(["id", "digest"]).drop("digest")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    across = (
        labelled.join(open_bands, "band", "left_semi")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "block", "id", "component",
        )
        .join(signatures, "id")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
    )
    reach = percent / 100 - 4.5 * float(np.sqrt(percent * (100 - percent)) / 100 / np.sqrt(bands * ROWS))
    pairs = across.mapInArrow(_across(reach, bands * ROWS, percent), "u bigint, v bigint").distinct()
    more = stored(_confirmed(pairs.join(star, ["u", "v"], "left_anti"), sets, percent), "across")
    final = components(
        more.unionByName(labels.select(F.col("component").alias("u"), F.col("node").alias("v")))
    )
    joined_rows = all_rows.join(final.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "id", "n", "class_id", F.coalesce("component", "class_id").alias("component")
    )

    def outward(name: str):
        return F.when(F.col(name) < LAST, F.col(name))

    return joined_rows.select(
        outward("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        outward("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
        outward("class_id").alias("class_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The documents that stay, all columns: one of each group, the one with the smallest id.

    Of rows that repeat a kept id the one whose text has the smallest hash stays. Rows without id stay.
    """
    kept = near_duplicates(docs, shingle, percent, id_column, text_column).filter("kept").select(
        F.col("doc_id").alias("_kept_id")
    )
    found = docs.join(kept.distinct(), docs[id_column].cast("bigint") == F.col("_kept_id"), "left_semi")
    row = F.struct(*[found[c] for c in docs.columns])
    text_hash = F.xxhash64(F.coalesce(found[text_column].cast("string"), F.lit("")))
    smallest = found.groupBy(found[id_column].alias("_id")).agg(F.min_by(row, text_hash).alias("_row"))
    return smallest.select("_row.*").unionByName(docs.filter(docs[id_column].isNull()))


def _sketches(shingle: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = Minima(bands * ROWS)
        base = splitmix(np.arange(9000, 9000 + ROWS, dtype="u8"))
        band_salt = splitmix(np.arange(9100, 9100 + bands, dtype="u8"))
        for ids, texts in together(batches):
            sizes, digests, sigs, odds, keys = [], [], [], [], []
            for own in shingle_sets(texts, shingle):
                sizes.append(len(own))
                digests.append(hashlib.md5(own).digest())
                if not len(own):
                    sigs.append(b"")
                    odds.append(b"")
                    keys.append([])
                    continue
                least = minima.of(own)
                sigs.append((least >> np.uint64(48)).astype("u2").tobytes())
                odds.append(odd_sketch(own))
                of_band = (least.reshape(bands, ROWS) * base).sum(axis=1, dtype="u8")
                keys.append(mixed(of_band + band_salt).view("i8"))
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(sigs, pa.binary()), pa.array(odds, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["id", "n", "digest", "sig", "odd", "keys"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in together(batches):
            sets = [own.tobytes() for own in shingle_sets(texts, shingle)]
            digests = [hashlib.md5(own).digest() for own in sets]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())],
                names=["id", "digest", "shingles"],
            )

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v with 100 * intersection >= percent * union, on their full sets."""
    one = sets.select(F.col("id").alias("v"), F.col("shingles").alias("of_v"))
    other = sets.select(F.col("id").alias("u"), F.col("shingles").alias("of_u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), "u8") for s in (a, b))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.record_batch(
                [batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], names=["u", "v"]
            )

    # The smaller id is the hot side: its joined partition may be split.
    both = pairs.join(one, "v").join(other, "u").select("u", "v", "of_u", "of_v")
    return both.mapInArrow(run, "u bigint, v bigint")


def _across(reach: float, count: int, percent: int):
    """Pairs of one block pair whose components differ and whose sketches and signatures agree enough.

    With the similarity of percent, (100 - percent) / (100 + percent) of both sizes together
    is the most that is not in common.
    """

    def pairs_of(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        if table.num_rows < 2:
            return
        ids = table.column("id").to_numpy()
        component = table.column("component").to_numpy()
        block = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        size = table.column("n").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "u2").reshape(-1, count)
        odd = np.frombuffer(b"".join(table.column("odd").to_pylist()), "u8").reshape(-1, ODD_BITS // 64)
        us, vs = [], []
        for k in range(len(ids)):
            others = component != component[k]
            others &= (block == j) & (block[k] == i) if i != j else np.arange(len(ids)) > k
            near = np.flatnonzero(others)
            apart = np.bitwise_count(odd[near] ^ odd[k]).sum(axis=1, dtype="i8")
            apart = np.maximum(apart, np.abs(size[near] - size[k]))
            near = near[(100 + percent) * apart <= (100 - percent) * (size[near] + size[k])]
            near = near[(sig[near] == sig[k]).sum(axis=1) >= reach * count]
            us.append(np.minimum(ids[near], ids[k]))
            vs.append(np.maximum(ids[near], ids[k]))
        yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by band, i, j; a group may go on in the next batch."""
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            own = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("band", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((own[1:] != own[:-1]).any(axis=1)) + 1).tolist(), len(own)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if held and key != tuple(own[low]):
                    yield from pairs_of(held)
                    held = []
                key = tuple(own[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from pairs_of(held)

    return run
