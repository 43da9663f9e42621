"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.session import work_folder

MOST_ROUNDS = 100


def _least(edges: DataFrame, path: str | None) -> DataFrame:
    """Each u with the smallest of its neighbours: combined before the shuffle.

    Stored if a path is given: only a join of two tables is split at run time on a hot node.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if path is None:
        return least
    least.write.parquet(path)
    return edges.sparkSession.read.parquet(path)


def large_star(edges: DataFrame, path: str | None = None) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u and its neighbours."""
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = edges.select(F.inline(ways))
    least = _least(both, path).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def small_star(edges: DataFrame, path: str | None = None) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them. Edges have u > v."""
    smallest = F.col("m").alias("v")
    links = F.array(F.struct("u", smallest), F.struct(F.col("v").alias("u"), smallest))
    return edges.join(_least(edges, path), "u").select(F.inline(links)).filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node that has a link; component is its smallest node.

    edges: two columns u, v of one orderable type, in either order, repeated or not. Links
    of a node to itself and links with NULL say nothing; no edges give no rows. A round is
    written to the shared folder, so neither lineage nor driver holds the graph; joins on a
    hot node are split at run time.
    """
    spark = edges.sparkSession
    folder = work_folder(spark, "components")

    def written(frame: DataFrame, round_: int) -> tuple[DataFrame, tuple]:
        frame.write.parquet(f"{folder}/{round_}")
        stored = spark.read.parquet(f"{folder}/{round_}")
        sums = [F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)")) for seed in (0, 1)]
        state = stored.agg(F.count("*"), *sums).first()
        return stored, tuple(state)

    now, state = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u > v")
        .distinct(),
        0,
    )
    for round_ in range(1, MOST_ROUNDS):
        if not state[0]:
            break
        before = state
        large = f"{folder}/large{round_}"
        large_star(now, f"{folder}/least{round_}").write.parquet(large)
        now, state = written(small_star(spark.read.parquet(large), f"{folder}/smaller{round_}"), round_)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    least = now.groupBy("v").agg(F.lit(1)).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least)
