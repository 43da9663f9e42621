"""Tables that are replaced whole: each write goes to a fresh folder and is switched to at its end."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.operators import loads

LOG = "name string, version bigint, path string"


@dataclass(frozen=True)
class Snapshots:
    """The versions of some tables below one folder, and a log of which one is the newest.

    A version's folder is never written again. It becomes the newest by one small file added to
    the log after its write has ended, so a write that fails changes nothing, and readers of an
    older version keep all of it. Each table has one writer at a time. Old versions stay until a
    retention rule of the storage removes them.
    """

    folder: str

    def newest(self, spark: SparkSession) -> dict[str, str]:
        """The folder of each table's newest version. The log has a row per write."""
        log = loads.stored_or_none(spark, f"{self.folder}/log", "json", LOG)
        last = log.groupBy("name").agg(F.max(F.struct("version", "path")).alias("last"))
        return {row.name: row.last.path for row in last.select(F.col("name"), "last").collect()}

    def versions(self, spark: SparkSession, name: str) -> list[str]:
        """The folders of all versions of a table, oldest first."""
        log = loads.stored_or_none(spark, f"{self.folder}/log", "json", LOG)
        rows = log.filter(F.col("name") == name).orderBy("version", "path").collect()
        return [row.path for row in rows]

    def replace(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write a table's next version and return its folder."""
        spark = df.sparkSession
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        with loads.open_files(spark):
            df.write.partitionBy(*partition_by).option("compression", loads.CODEC).parquet(path)
        log = loads.stored_or_none(spark, f"{self.folder}/log", "json", LOG)
        last = log.filter(F.col("name") == name).agg(F.max("version")).first()[0]
        row = spark.createDataFrame([(name, (last or 0) + 1, path)], LOG)
        row.coalesce(1).write.mode("append").json(f"{self.folder}/log")
        return path


def show_as(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Let a catalog name stand for a version. The catalog replaces its entry at once.

    The name is a view on the version's files, so partitions are pruned as by path. A table
    that had the name before goes from the catalog; its files stay.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)
