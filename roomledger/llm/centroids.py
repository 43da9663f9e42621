"""Clustering of vectors by their nearest centroid, found with the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.session import work_folder

SCALE = 256.0
# Components beyond this are held at it, so that no squared distance leaves a bigint.
LARGEST = 1 << 27
# Vectors searched at once in a task.
TOGETHER = 1024
FAR = np.iinfo("i8").max


class SortedLists:
    """Centroids with one list for each dimension, sorted by the centroids' values there."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.centroids = np.array(centroids, "i8")
        self.order = np.argsort(self.centroids, axis=0, kind="stable").T.copy()
        self.values = np.sort(self.centroids, axis=0).T.copy()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each vector (ties: the smaller), its squared
        distance, and how many distances were computed.

        Every list is walked outward from the vector's value, its next nearest entry at each
        step. A centroid met for the first time gets its exact distance. A centroid not met
        yet is at least as far as the frontier in every dimension, so a vector is done once
        the frontier's squared distances add up to strictly more than the best one.
        """
        n, dims = vectors.shape
        k = len(self.centroids)
        best, found = np.full(n, FAR), np.zeros(n, "i8")
        met = np.zeros((n, k), bool)
        right = np.stack(
            [np.searchsorted(self.values[d], vectors[:, d]) for d in range(dims)], axis=1
        ) if n else np.zeros((0, dims), "i8")
        left = right - 1
        dim = np.arange(dims)
        open_, computed = np.arange(n), 0
        while len(open_):
            x, lo, hi = vectors[open_], left[open_], right[open_]
            below = np.where(lo >= 0, x - self.values[dim, np.maximum(lo, 0)], FAR)
            above = np.where(hi < k, self.values[dim, np.minimum(hi, k - 1)] - x, FAR)
            down = below <= above
            at = np.where(down, np.maximum(lo, 0), np.minimum(hi, k - 1))
            left[open_], right[open_] = lo - down, hi + ~down
            new = np.zeros((len(open_), k), bool)
            new[np.arange(len(open_))[:, None], self.order[dim, at]] = True
            new &= ~met[open_]
            met[open_] |= new
            row, number = np.nonzero(new)
            computed += len(row)
            distances = np.full(new.shape, FAR)
            distances[row, number] = ((x[row] - self.centroids[number]) ** 2).sum(axis=1)
            nearest = distances.argmin(axis=1)
            least = distances[np.arange(len(open_)), nearest]
            better = (least < best[open_]) | ((least == best[open_]) & (nearest < found[open_]))
            better &= least < FAR
            best[open_[better]], found[open_[better]] = least[better], nearest[better]
            frontier = np.minimum(below, above)
            beyond = (frontier**2).sum(axis=1) > best[open_]
            open_ = open_[~(beyond | met[open_].all(axis=1))]
        return found, best, computed


def whole_numbers(embedding: Column, dims: int, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component, NULL unless there are dims finite ones."""
    doubles = embedding.cast("array<double>")
    fits = (F.size(doubles) == dims) & F.forall(
        doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    held = F.transform(
        doubles,
        lambda x: F.floor(
            F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x * F.lit(scale)))
        ).cast("int"),
    )
    return F.when(fits, held)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("i8").reshape(-1, dims)


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and distance of every vector. The centroids travel with the task."""
    dims = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                found, best, _ = lists.nearest(_matrix(part.column(1), dims))
                columns = [part.column(0), pa.array(found.astype("i4")), pa.array(best)]
                yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """cluster, vectors and sums, the exact sum of each component; combined inside each task."""
    dims, k = len(centroids[0]), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        # A task's sums fit: its rows times LARGEST would have to pass 2 ** 63.
        counts, sums = np.zeros(k, "i8"), np.zeros((k, dims), "i8")
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = _matrix(batch.slice(at, TOGETHER).column(1), dims)
                found = lists.nearest(part)[0]
                counts += np.bincount(found, minlength=k)
                np.add.at(sums, found, part)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.record_batch(
                [
                    pa.array(some.astype("i4")),
                    pa.array(counts[some]),
                    pa.array(sums[some].tolist(), pa.list_(pa.int64())),
                ],
                names=["cluster", "vectors", "sums"],
            )

    parts = vectors.mapInArrow(run, "cluster int, vectors bigint, sums array<bigint>")
    each = parts.select("cluster", "vectors", F.posexplode("sums").alias("dim", "part"))
    wide = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    return each.groupBy("cluster", "dim").agg(F.sum("vectors").alias("vectors"), wide)


def _moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid with vectors moves to their mean, rounded down; the others stay."""
    moved = [list(c) for c in centroids]
    # k times dims rows at most, whatever the number of vectors.
    for row in _sums(vectors, centroids).collect():
        moved[row.cluster][row.dim] = int(row.total) // row.vectors
    return moved


def centroid_clusters(
    embeddings: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    seed: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and squared distance of every kept vector, stored, and the k centroids.

    Vectors are whole numbers, floor(256 * x) of each component; rows without exactly dims
    finite ones are left out, NULL vectors among them. The centroids start as the k vectors
    whose `seed:vec_id` has the smallest SHA-256, in that order; of equal ids the smaller
    vector comes first, and a NULL id counts as empty text. With fewer vectors there are
    fewer centroids, with none no rows. Rows that repeat an id or a vector are vectors of their
    own; of centroids at the same distance the smaller number wins, so of equal
    ones only the first has vectors. Components beyond 2 ** 27 are held there. Other columns
    are not read.

    Each round sends k * dims numbers with its tasks and gets at most as many sums back;
    nothing else reaches the driver, and no vector is shuffled.
    """
    spark = embeddings.sparkSession
    folder = work_folder(spark, "centroids")
    whole = embeddings.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        whole_numbers(F.col(vector_column), dims).alias("vector"),
    )
    whole.filter(F.col("vector").isNotNull()).write.parquet(f"{folder}/vectors")
    vectors = spark.read.parquet(f"{folder}/vectors")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = vectors.orderBy(F.sha2(name.cast("binary"), 256), "vector").limit(k)
    centroids = [list(row.vector) for row in drawn.select("vector").collect()]
    if not centroids:
        return vectors.selectExpr("vec_id", "0 as cluster", "0L as distance"), []
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    _assigned(vectors, centroids).write.parquet(f"{folder}/clusters")
    return spark.read.parquet(f"{folder}/clusters"), centroids


def inertias(embeddings: DataFrame, **settings: object) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    The same rules as centroid_clusters. Sums of distances beyond a bigint are held at its largest.
    """
    clusters, centroids = centroid_clusters(embeddings, **settings)
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    # One row for each centroid with vectors, k at most.
    own = {row.cluster: int(row.total) for row in clusters.groupBy("cluster").agg(wide).collect()}
    largest = int(FAR)
    every = min(sum(own.values()), largest)
    rows = [
        (number, min(own.get(number, 0), largest), every, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for number, c in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    named = embeddings.sparkSession.createDataFrame(rows, schema)
    return clusters.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
