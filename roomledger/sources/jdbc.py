"""Relational tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Reads a large table over several connections, by ranges of a numeric or date column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_options(
    url: str, table: str, driver: str, split: Split | None = None, **more: str
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "driver": driver, **more}
    return {**options, **split.options()} if split else options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str,
    split: Split | None = None,
    **more: str,
) -> DataFrame:
    """A table with the types its database reports; filters on it run in the database.

    Without a split the table comes over one connection, which suits small
    reference tables only.
    """
    options = jdbc_options(url, table, driver, split, **more)
    return spark.read.format("jdbc").options(**options).load()
