"""Columns of few values, as numbers in few bigints while rows are shuffled."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Different texts of a column that is coded.
MOST_VALUES = 128
# A whole number is coded if its range takes so many bits.
MOST_BITS = 24
_WORD = 62


def coded(rows: DataFrame, columns: list[str]) -> tuple[list[Column], dict[str, Column]]:
    """Bigints that hold some of the columns, and each of these columns taken from the bigints.

    Nothing is lost: texts are coded by the list of all that occur, whole numbers by their distance
    from the least one, NULL as 0. Columns of other types, many texts or a wide range are left out. rows
    are read twice, so they must be stored; the bigints are right for them and any part of them only.
    """
    kinds = dict(rows.dtypes)
    numbers = [c for c in columns if kinds[c] in ("tinyint", "smallint", "int", "bigint")]
    texts = [c for c in columns if kinds[c] == "string"]
    if not numbers and not texts:
        return [], {}
    ends = [f(c).alias(f"{f.__name__}{k}") for k, c in enumerate(numbers) for f in (F.min, F.max)]
    found = rows.agg(*ends, *[F.approx_count_distinct(c).alias(f"texts{k}") for k, c in enumerate(texts)]).first()
    ranges = {c: (found[f"min{k}"], found[f"max{k}"]) for k, c in enumerate(numbers)}
    few = [c for k, c in enumerate(texts) if found[f"texts{k}"] <= MOST_VALUES]
    lists = dict(zip(few, rows.agg(*[F.sort_array(F.collect_set(c)) for c in few]).first())) if few else {}

    codes: dict[str, tuple[int, Column]] = {}
    values: dict[str, Callable] = {}
    for name, (least, most) in ranges.items():
        if least is None or (most - least + 1).bit_length() > MOST_BITS:
            continue
        codes[name] = (most - least + 1).bit_length(), F.col(name).cast("bigint") - (least - 1)
        values[name] = lambda code, least=least: F.when(code > 0, code + (least - 1))
    for name, texts_of in lists.items():
        if not texts_of:
            continue
        known = F.array(*map(F.lit, texts_of))
        codes[name] = len(texts_of).bit_length(), F.array_position(known, F.col(name))
        values[name] = lambda code, known=known: F.get(known, code.cast("int") - 1)

    words: list[list[Column]] = []
    unpacked, used = {}, _WORD
    for name, (bits, code) in codes.items():
        if used + bits > _WORD:
            words.append([])
            used = 0
        words[-1].append(F.shiftleft(F.coalesce(code, F.lit(0)), used))
        taken = F.shiftright(f"_word{len(words) - 1}", used).bitwiseAND((1 << bits) - 1)
        unpacked[name] = values[name](taken).cast(kinds[name]).alias(name)
        used += bits
    packed = [reduce(Column.bitwiseOR, word).alias(f"_word{k}") for k, word in enumerate(words)]
    return packed, unpacked
