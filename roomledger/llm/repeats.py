"""Repeated byte strings: maximal repeats from the interval tree of an enhanced suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.passages import INDEX_BYTES, LAST, Covered, Segment, Unit, segments_of, without_covered
from roomledger.session import work_folder

# Seeds of this many bytes; shorter if the least length is.
SEED = 32

DIVERSE = object()
# A maximal repeat: its length and the places (in the joined text) of all occurrences.
Repeats = Iterator[tuple[int, np.ndarray]]


class SuffixArray:
    """Suffixes of several strings that are at least `least` long, sorted, with common prefixes.

    Ranks of prefixes of 8, 16, 32 and 64 bytes come from doubling; a string's end sorts
    before every byte. The strings are UTF-8, so that byte + 1 fits a byte.
    """

    LEVELS = (8, 16, 32, 64)

    def __init__(self, strings: list[bytes], least: int) -> None:
        lengths = np.array(list(map(len, strings)), "i8")
        self.starts = np.cumsum(lengths) - lengths
        n = int(lengths.sum())
        codes = np.zeros(n + 8, "u1")
        codes[:n] = np.frombuffer(b"".join(strings), "u1") + np.uint8(1)
        self.codes = codes
        self.owner = np.repeat(np.arange(len(strings)), lengths)
        self.room = np.repeat(self.starts + lengths, lengths) - np.arange(n)
        key = np.zeros(n, "u8")
        for k in range(8):
            key = (key << np.uint64(8)) | np.where(self.room > k, codes[k : k + n], 0).astype("u8")
        self.ranks = {8: self._ranked(key)}
        for level in self.LEVELS[:-1]:
            own = self.ranks[level]
            self.ranks[2 * level] = self._ranked(own.astype("u8") * np.uint64(n + 1) + self._beyond(own, level, np.arange(n)))
        at = np.flatnonzero(self.room >= least)
        top = self.ranks[64]
        step = int(self.room.max(initial=0)) // 64
        keys = [at, *(self._beyond(top, 64 * k, at) for k in range(step, 0, -1)), top[at]]
        self.order = at[np.lexsort(keys)]
        self.common = self._common(self.order[:-1], self.order[1:]) if len(at) > 1 else np.zeros(0, "i8")
        before = np.append(0, codes[: max(n - 1, 0)]).astype("i8")[:n]
        before[self.starts[lengths > 0]] = -1 - self.starts[lengths > 0]
        self.before = before

    @staticmethod
    def _ranked(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        found = key[order]
        rank = np.empty(len(key), "i4")
        rank[order] = np.cumsum(np.append(True, found[1:] != found[:-1])[: len(key)])
        return rank

    def _beyond(self, rank: np.ndarray, step: int, at: np.ndarray) -> np.ndarray:
        """Rank of what follows after `step` bytes of a suffix; 0 at its string's end."""
        to = np.minimum(at + step, len(rank) - 1)
        return np.where(self.room[at] > step, rank[to], 0).astype("u8")

    def _common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Bytes that pairs of suffixes have in common, by equal ranks of falling length."""
        i, j, limit = one.copy(), other.copy(), np.minimum(self.room[one], self.room[other])
        done = np.zeros(len(i), "i8")
        last = len(self.room) - 1
        times = int(limit.max(initial=0)) // 64
        for level in [64] * times + [32, 16, 8]:
            rank = self.ranks[level]
            same = (limit - done >= level) & (rank[np.minimum(i, last)] == rank[np.minimum(j, last)])
            step = same * level
            i, j, done = i + step, j + step, done + step
        for _ in range(7):
            same = (done < limit) & (self.codes[i] == self.codes[j])
            i, j, done = i + same, j + same, done + same
        return done


def maximal_repeats(array: SuffixArray, least: int) -> Repeats:
    """Every string of `least` or more bytes that occurs twice and cannot be extended.

    The suffix array is scanned with a stack of common-prefix intervals. To the right an
    interval's string cannot grow by definition; to the left it cannot if the bytes before
    its occurrences differ, a string's start counting as different from all.
    """
    left = array.before[array.order]
    joins = array.common >= least
    edges = np.diff(np.concatenate([[False], joins, [False]]).astype("i1"))
    lows, highs = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    pairs = highs - lows == 1
    for low in lows[pairs][left[lows[pairs]] != left[lows[pairs] + 1]].tolist():
        yield int(array.common[low]), array.order[low : low + 2]
    for low, high in zip(lows[~pairs].tolist(), highs[~pairs].tolist()):
        common = array.common[low:high].tolist() + [0]
        marks = left[low : high + 1].tolist()
        stack: list[list] = []
        for k, size in enumerate(common):
            start, mark = low + k, marks[k]
            while stack and stack[-1][0] > size:
                length, start, own = stack.pop()
                mark = own if own == mark else DIVERSE
                if mark is DIVERSE:
                    yield length, array.order[start : low + k + 1]
            if stack and stack[-1][0] == size:
                if stack[-1][2] != mark:
                    stack[-1][2] = DIVERSE
            elif size:
                stack.append([size, start, mark])


def later_occurrences(least: int):
    """An index for passages: all but the earliest occurrence of each maximal repeat."""

    def index(segments: list[Segment]) -> Covered:
        array = SuffixArray([s.content for s in segments], least)
        place = sorted(range(len(segments)), key=lambda k: (segments[k].doc, int(segments[k].starts[0]), segments[k].cls))
        # Segments of one document may overlap, so occurrences are ordered by their own place.
        docs = np.empty(len(segments), "i8")
        docs[place] = np.cumsum([
            k > 0 and (segments[place[k]].doc, segments[place[k]].cls) != (segments[place[k - 1]].doc, segments[place[k - 1]].cls)
            for k in range(len(place))
        ])
        starts = np.array([s.starts[0] for s in segments], "i8")
        owner, inner = array.owner, np.arange(len(array.owner)) - array.starts[array.owner]
        doc, at = docs[owner], starts[owner] + inner
        covered = []
        for length, where in maximal_repeats(array, least):
            first = np.lexsort((at[where], doc[where]))[0]
            same = (doc[where] == doc[where[first]]) & (at[where] == at[where[first]])
            later = where[~same]
            covered += zip(owner[later].tolist(), inner[later].tolist(), (inner[later] + length).tolist())
        return covered

    return index


def unit(least: int) -> Unit:
    return Unit("byte", least, min(SEED, max(least // 2, 1)))


def repeat_groups(
    docs: DataFrame, least: int = 100, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """All occurrences of repeated strings: group, length, doc_id, start (in UTF-8 bytes).

    A group is a string of `least` or more bytes found in several places of different texts or
    of one text. Groups are found around seeds, and those whose occurrences are the same but
    for a shift are one as far as they touch. Where a part of a long repeat occurs elsewhere
    too, that part has other occurrences, and the long repeat shows as groups around it. Of
    equal texts one is searched, and its occurrences are given for all ids; a text of `least` or
    more bytes with several ids is a group itself. group is a hash of the first occurrence and
    length. NULL and empty texts have no occurrences, NULL ids come as NULL. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("cls", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents: dict[bytes, list[tuple[int, int]]] = {}  # classes and starts
        seed, size = None, 0

        def flush() -> pa.RecordBatch:
            strings = list(contents)
            array = SuffixArray(strings, least)
            out = []
            once = [np.array([array.starts[k]]) for k in range(len(strings)) if len(contents[strings[k]]) > 1]
            whole = ((len(strings[array.owner[w[0]]]), w) for w in once)
            for length, where in [*maximal_repeats(array, least), *whole]:
                own, inner = array.owner[where], where - array.starts[array.owner[where]]
                text = strings[own[0]][inner[0] : inner[0] + length]
                name = _name(text)
                places = {(d, s + i) for k, i in zip(own.tolist(), inner.tolist()) for d, s in contents[strings[k]]}
                if len(places) > 1:
                    out += [(name, length, *p) for p in places]
            columns = list(zip(*out)) or [()] * 4
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["name", "length", "cls", "start"])

        for batch in batches:
            for s, _, cls, starts, _, content in zip(*(c.to_pylist() for c in batch.columns)):
                if s != seed and size >= INDEX_BYTES:
                    yield flush()
                    contents, size = {}, 0
                seed = s
                if content not in contents:
                    size += len(content)
                contents.setdefault(content, []).extend((cls, start) for start in starts)
        yield flush()

    dealt = segments_of(rows, unit(least), within_document=True, collapse=False)
    folder = work_folder(spark, "groups")
    dealt.mapInArrow(run, "name bigint, length bigint, cls bigint, start bigint").distinct().write.parquet(f"{folder}/found")
    _merged(spark.read.parquet(f"{folder}/found")).write.parquet(f"{folder}/merged")
    groups = spark.read.parquet(f"{folder}/merged")

    copied = (
        rows.groupBy("cls")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.max(F.octet_length("text")).cast("bigint").alias("length"))
        .filter((F.col("low") < F.col("high")) & (F.col("length") >= least))
    )
    start = F.lit(0).cast("bigint")
    whole = copied.join(groups.filter("start = 0"), ["cls", "length"], "left_anti").select(
        F.xxhash64("cls", start, "length").alias("group"), "length", "cls", start.alias("start")
    )
    places = groups.unionByName(whole).join(rows.select("cls", "id").distinct(), "cls")
    return places.select("group", "length", F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"), "start")


def _merged(found: DataFrame) -> DataFrame:
    """group, length, cls, start: groups with the same occurrences but for a shift, merged where they touch.

    found: name, length, cls, start. Occurrences are compared relative to the first of a group
    by combined hashes, so no group is held anywhere; the groups of one window start in one text.
    """
    of_group = ["name", "length"]
    firsts = found.groupBy(*of_group).agg(F.min(F.struct("cls", "start")).alias("first"))
    shapes = (
        found.join(firsts, of_group)
        .groupBy(*of_group, F.col("first.cls").alias("first_cls"), F.col("first.start").alias("first_start"))
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("cls", F.col("start") - F.col("first.start"))).alias("shape"),
        )
        .select(*of_group, F.col("first_cls").alias("cls"), F.col("first_start").alias("start"), "n", "shape")
    )
    along = Window.partitionBy("cls", "n", "shape").orderBy("start", "length", "name")
    end = F.col("start") + F.col("length")
    before = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= before, 0).otherwise(1)
    runs = shapes.withColumn("opens", opens).withColumn("run", F.sum("opens").over(along))
    longest = (
        runs.groupBy("cls", "n", "shape", "run")
        .agg(F.min(F.struct("start", "length", "name")).alias("first"), F.max(end).alias("end"))
        .withColumn("whole", F.col("end") - F.col("first.start"))
        .select(
            F.col("first.name").alias("name"), F.col("first.length").alias("length"), "whole",
            F.xxhash64("cls", F.col("first.start"), "whole").alias("group"),
        )
    )
    return found.join(longest, of_group).select("group", F.col("whole").alias("length"), "cls", "start")


def _name(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def without_repeats(
    docs: DataFrame, least: int = 100, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of `least` bytes that covers it also starts earlier: in a document
    with a smaller id, or earlier in the same one. Strings are judged on the input and never
    cross documents. NULL text is empty. A NULL id counts as the largest and stays NULL. Rows
    that repeat id and text get equal results; of two texts with one id the order is fixed
    but has no meaning. An empty table gives no rows. Other columns are not read.
    """
    found = without_covered(docs, unit(least), later_occurrences(least), True, id_column, text_column)
    return found.withColumnRenamed("symbols", "n_bytes")
