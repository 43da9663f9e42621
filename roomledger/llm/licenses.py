"""License notices in texts: MinHash bands of overlapping windows, verified by containment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of common notices. A template may be of any length.
NOTICES = {
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License",
}

# Words in a window, words between the starts of two, words in a shingle, and hash functions.
# A template of WINDOW - STEP + 1 words or fewer lies whole in some window; of a longer one some
# window holds at least that many. Two of three words in common with the nearest template window
# give a similarity of 0.4 or more, which all BANDS miss with probability 0.6 ** 14 = 0.0008.
WINDOW, STEP, SHINGLE, BANDS = 6, 3, 2, 14
CONTAINMENT = 0.8


def shingled(rows: DataFrame, text: str) -> DataFrame:
    """Add _hashes: a hash of each two neighbouring words, and drop the text.

    Words are runs of ASCII letters and digits, case folded; NULL text has none. Each step is
    a column of its own, so that none is computed twice.
    """
    rest = [c for c in rows.columns if c != text]
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), "[^a-z0-9]+", " "))
    words = F.split("_plain", " ")
    size = F.when(F.col("_plain") == "", F.lit(0)).otherwise(F.size("_words") - 1)
    hashes = F.zip_with(
        F.slice("_words", 1, F.col("_size")), F.slice("_words", 2, F.col("_size")), lambda a, b: F.xxhash64(a, b)
    )
    return (
        rows.select(*rest, plain.alias("_plain"))
        .select(*rest, "_plain", words.alias("_words"))
        .select(*rest, "_words", size.alias("_size"))
        .select(*rest, hashes.alias("_hashes"))
    )


def banded(rows: DataFrame, step: int, reach: int) -> DataFrame:
    """One row per window and band: start and key; the columns of rows stay.

    Windows start every `step` shingles, the last where `reach` more may follow. A band is one
    hash function; its key is the function's least value over the shingles of the window.
    """
    last = F.greatest(F.size("_hashes") - 1 - reach, F.lit(0))
    starts = F.sequence(F.lit(0), last, F.lit(step))
    windows = rows.filter(F.size("_hashes") > 0).select("*", F.explode(starts).alias("start"))
    each = windows.select("*", F.explode(F.array(*[F.lit(band) for band in range(BANDS)])).alias("band"))
    shingle = [F.get("_hashes", F.col("start") + k) for k in range(WINDOW - 1)]
    values = [F.when(h.isNotNull(), F.xxhash64(h, F.col("band"))) for h in shingle]
    return each.select(*windows.columns, F.least(*values).alias("key"))


def template_keys(docs: DataFrame, notices: Mapping[str, str]) -> DataFrame:
    """key, license, wanted (distinct shingle hashes), length of every template window.

    Templates are parameters, so this table's size is fixed before any data are read.
    """
    rows = docs.sparkSession.createDataFrame(list(notices.items()), "license string, notice string")
    keyed = banded(shingled(rows, "notice"), 1, WINDOW - 2)
    return keyed.select(
        "key", "license", F.array_distinct("_hashes").alias("wanted"), F.size("_hashes").alias("length")
    ).distinct()


def license_scan(
    docs: DataFrame,
    notices: Mapping[str, str] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document and license: doc_id, license, containment, word, windows, text_hash.

    Every window of a text that shares a band key with a template retrieves it. The template's
    shingles are then looked up around the window: containment is the share found, at best,
    and the license counts if it is CONTAINMENT or more. word is the start of the first window
    that shows it, windows how many do.

    Bands are joined where the text lies, with the table of templates only; texts are not
    shuffled. NULL, empty and one-word texts have no license. Rows with equal id (NULL too)
    and text give one row per license. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).alias("_text"),
    )
    found = banded(shingled(rows, "_text"), STEP, 0).join(F.broadcast(template_keys(docs, notices)), "key")
    low = F.greatest(F.col("start") - F.col("length") - 1, F.lit(0))
    around = F.slice("_hashes", low + 1, F.col("start") - low + F.col("length") + WINDOW + 1)
    share = F.size(F.array_intersect("wanted", around)) / F.size("wanted")
    return (
        found.select("doc_id", "text_hash", "license", F.col("start").alias("word"), share.alias("containment"))
        .filter(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "text_hash", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.min("word").alias("word"),
            F.count_distinct("word").alias("windows"),
        )
        .select("doc_id", "license", "containment", "word", "windows", "text_hash")
    )
