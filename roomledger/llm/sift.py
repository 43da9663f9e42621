"""A filter of fixed size for ids, so that a join moves few rows that have no partner."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The filter is a bit map of this size at most, whatever the data: 4 MB.
BITS = 1 << 25


def sifted(rows: DataFrame, column: str, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose id may be among the wanted ids: a superset of the semi join.

    Two bits per id are set in a map of fixed size, made by an aggregation and broadcast.
    Ids that are wanted always pass. The fuller the map, the more others pass too, so the
    caller's join decides and never depends on this. NULL ids do not pass.
    wanted: one column with the same name.
    """
    def bit(seed: int):
        return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(bits))

    of_word = (
        wanted.select(F.explode(F.array(bit(1), bit(2))).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    )
    found = of_word.toPandas()
    words = np.zeros(bits // 64, "u8")
    words[found["word"].to_numpy("i8")] = found["bits"].to_numpy("i8").view("u8")

    @F.pandas_udf("boolean")
    def may_be(first: pd.Series, second: pd.Series) -> pd.Series:
        one, two = first.to_numpy().astype("u8"), second.to_numpy().astype("u8")
        low = np.uint64(63)
        hit = (words[one >> np.uint64(6)] >> (one & low)) & (words[two >> np.uint64(6)] >> (two & low))
        return pd.Series((hit & np.uint64(1)).astype(bool))

    return rows.filter(F.col(column).isNotNull()).filter(may_be(bit(1), bit(2)))
