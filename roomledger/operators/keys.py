"""Surrogate keys that are given once and kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.operators import loads
from roomledger.operators.numbering import number_rows


def registered(members: DataFrame, natural: str, key: str, path: str, folder: str) -> DataFrame:
    """The registry of a dimension's keys, after new members got theirs: key, natural.

    A member is known by one natural column. Those the registry at path does not have are
    numbered after its largest key, in ascending order, and added to it; no row of it ever
    changes, so a fact that carries a key keeps its meaning. Members that are gone keep theirs.
    A first load numbers 1..n. NULL is no member, repeated members count once.

    An addition that was cut short leaves the members it stored with their keys, and the next
    load numbers the others: keys may have gaps, but never two members. One load runs at a time;
    a second one that ran beside it is found by the keys given twice.
    folder: a fresh path for the numbering.
    """
    spark = members.sparkSession
    kind = members.schema[natural].dataType.simpleString()
    schema = f"`{key}` bigint, `{natural}` {kind}"
    stored = loads.stored_or_none(spark, path, "parquet", schema)
    asked = members.select(natural).filter(F.col(natural).isNotNull()).distinct()
    unseen = asked.join(stored.select(natural), natural, "left_anti")
    last = stored.agg(F.max(key)).first()[0] or 0
    new = number_rows(unseen, [natural], key, folder, unique=True, first=last + 1)
    new.select(F.col(key).cast("bigint").alias(key), natural).write.mode("append").parquet(path)
    registry = loads.stored_or_none(spark, path, "parquet", schema)
    given = registry.agg(F.count("*"), F.count_distinct(key), F.count_distinct(natural)).first()
    if len(set(given)) != 1:
        raise ValueError(f"{path} has keys or members twice: two loads ran at once")
    return registry
