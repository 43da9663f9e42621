"""Left joins from a fact to its dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A broadcast dimension has a handful of narrow columns: some 50 MB at this size.
MAX_BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Dimension:
    """A dimension with its row count, which decides how it may be joined."""

    frame: DataFrame
    rows: int

    @classmethod
    def counted(cls, frame: DataFrame) -> Dimension:
        """Count a stored dimension: for Parquet this reads file footers only."""
        return cls(frame, frame.count())

    def select(self, *columns: str) -> Dimension:
        return Dimension(self.frame.select(*columns), self.rows)


def lookup(
    fact: DataFrame,
    dimension: Dimension,
    on: str | Column,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left outer join that keeps every fact row; unmatched attributes are NULL.

    A dimension counted within the bound is broadcast, so the fact is not shuffled.
    A larger one is left to a shuffle join, whose hot keys (NULL among them)
    adaptive execution splits over several tasks.
    """
    small = dimension.rows <= max_broadcast_rows
    side = F.broadcast(dimension.frame) if small else dimension.frame
    return fact.join(side, on, "left")


# Parts that the rows of a hot key are dealt over in a shuffle join.
PARTS = 32
# A key is hot if it holds more than this share of the rows. So many counters find all such keys.
SHARE, COUNTERS = 0.005, 2_000


def hot_keys(fact: DataFrame, column: str, share: float = SHARE) -> list:
    """The values of a column that hold more than a share of its rows; 1 / share at most.

    Found by a sketch of bounded size in one pass over one column, combined per task. Its
    counts may be too high for values near the share: a few may be listed that are not hot.
    """
    most = max(int(1 / share), 1)
    top = F.expr(f"approx_top_k(`{column}`, {most}, {COUNTERS})")
    found = fact.filter(F.col(column).isNotNull()).agg(F.count(column).alias("rows"), top.alias("top")).first()
    return [entry["item"] for entry in found.top or [] if entry["count"] > share * found.rows]


def lookup_dealt(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    hot: list,
    spread_by: str,
    parts: int = PARTS,
) -> DataFrame:
    """Left outer shuffle join whose hot keys are dealt over parts, for batches and streams.

    A stream's join is planned before its rows are seen, so hot keys cannot be split at run time.
    Facts of a hot key, and those without key, get a part by the hash of another column;
    the members of hot keys, a bounded number, are there once for each part. The fact is read
    once. Its columns and the dimension's come out as from lookup.
    """
    spread = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")
    is_hot = F.col(fact_key).isin(hot) if hot else F.lit(False)
    dealt = fact.withColumn("_part", F.when(F.coalesce(is_hot, F.lit(True)), spread).otherwise(0))
    every = F.array(*[F.lit(k) for k in range(parts)]) if hot else F.array(F.lit(0))
    member_is_hot = F.coalesce(F.col(dimension_key).isin(hot), F.lit(False)) if hot else F.lit(False)
    places = F.when(member_is_hot, every).otherwise(F.array(F.lit(0)))
    members = dimension.select("*", F.explode(places).alias("_member_part"))
    on = (F.col(fact_key) == F.col(dimension_key)) & (F.col("_part") == F.col("_member_part"))
    return dealt.join(members, on, "left").drop("_part", "_member_part")
