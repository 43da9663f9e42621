"""Passages that several texts share: seeds find them, segments bring them to one index.

A window is some consecutive symbols (bytes or words). Each window has a seed: the run of a
few symbols in it whose hash is least. Equal windows have equal seeds at equal places, and
neighbouring windows mostly share theirs. So a window that occurs twice lies, both times, in a
segment (the windows of one seed) with that seed, and an index over the segments of a seed
sees all its occurrences. Seeds that occur in one place only are dropped first. A seed with too
many different contents for one index is parted by its windows' digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.rolling import TOGETHER, grams, mixed, powers, splitmix, together, words
from roomledger.llm.sift import sifted
from roomledger.session import work_folder

LAST = (1 << 63) - 1
# Windows looked at together; their places must fit PLACE bits.
PIECE, PLACE = 1 << 19, 20
# Bytes of segments in one index. A seed with more different contents is hot: its segments are let go
# and their windows dealt out by digest.
INDEX_BYTES = 1 << 21
# A seed's number in its text, modulo this, shares a long with the seed's hash.
NUMBER_BITS = 16

_BYTE = splitmix(np.arange(2000, 2256, dtype="u8"))
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


@dataclass(frozen=True)
class Unit:
    """What windows are made of, and how long windows and seeds are."""

    kind: str
    window: int
    seed: int

    def symbols(self, text: bytes) -> tuple[int, np.ndarray | None, np.ndarray | None]:
        """Number of symbols; for words also where each starts and ends in bytes."""
        if self.kind == "byte":
            return len(text), None, None
        found = words(np.frombuffer(text, "u1"), lower=False)
        return len(found.hashes), found.starts, found.ends

    def seed_hashes(self, text: bytes, hashes: np.ndarray | None) -> np.ndarray:
        if self.kind == "word":
            return grams(hashes, self.seed)
        sums = np.zeros(len(text) + 1, "u8")
        np.cumsum(_BYTE[np.frombuffer(text, "u1")] * powers(_STEP, len(text)), out=sums[1:])
        size = len(text) - self.seed + 1
        return mixed((sums[self.seed :] - sums[:size]) * powers(_BACK, size))

    def seeds(self, text: bytes) -> Seeds:
        """All seeds of a text in order, each with the first and the last window it stands for."""
        starts = ends = hashes = None
        n = len(text)
        if self.kind == "word":
            found = words(np.frombuffer(text, "u1"), lower=False)
            n, starts, ends, hashes = len(found.hashes), found.starts, found.ends, found.hashes
        reach = self.window - self.seed + 1
        values, lows, highs = [], [], []
        for at in range(0, max(n - self.window + 1, 0), PIECE):
            to = min(at + PIECE, n - self.window + 1)
            if self.kind == "word":
                own = grams(hashes[at : to + self.window - 1], self.seed)
            else:
                own = self.seed_hashes(text[at : to + self.window - 1], None)
            mask = np.uint64((1 << PLACE) - 1)
            least = (own & ~mask) | np.arange(len(own), dtype="u8")
            covered = 1
            while covered * 2 <= reach:
                least = np.minimum(least[:-covered], least[covered:])
                covered *= 2
            if covered < reach:
                least = np.minimum(least[: len(least) - (reach - covered)], least[reach - covered :])
            place = (least & mask).astype("i8")
            first = np.flatnonzero(np.diff(place, prepend=-1))
            values.append(own[place[first]])
            lows.append(first + at)
            highs.append(np.append(first[1:], to - at) - 1 + at)
        none = np.zeros(0, "i8")
        return Seeds(
            np.concatenate([np.zeros(0, "u8"), *values]), np.concatenate([none, *lows]),
            np.concatenate([none, *highs]), n, starts, ends,
        )


@dataclass
class Seeds:
    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    symbols: int
    starts: np.ndarray | None
    ends: np.ndarray | None


@dataclass
class Segment:
    """A distinct content with the first place it was found: document, text class, starts."""

    content: bytes
    doc: int
    cls: int
    starts: np.ndarray
    size: int


# For each covered stretch: number of the segment, first symbol and end, relative to it.
Covered = list[tuple[int, int, int]]


def covered_spans(
    rows: DataFrame, unit: Unit, index: Callable[[list[Segment]], Covered], within_document: bool
) -> DataFrame:
    """id, cls, spans: stretches of symbols whose windows occur in an earlier place too.

    rows: id, cls, text of distinct texts at least once each. An earlier place has a smaller
    id or, within_document, the same id and text and an earlier start. index gets segments
    of some seeds with several different contents each and names the covered stretches.
    The contents of a seed that would make an index of more than INDEX_BYTES are not indexed:
    equal windows share their digest too, so the windows of such a seed are dealt out by it.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, "indexed")
    dealt = segments_of(rows, unit, within_document)
    dealt.mapInArrow(
        _indexed(index, within_document), "id bigint, cls bigint, low bigint, high bigint, starts array<bigint>, content binary"
    ).write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    spans = found.filter("content is null").select("id", "cls", "low", "high")
    hot = found.filter("content is not null").select("id", "cls", "starts", "content")
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(hot, unit, within_document, folder))
    return spans.groupBy("id", "cls").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def _hot_spans(hot: DataFrame, unit: Unit, within_document: bool, folder: str) -> DataFrame:
    """id, cls, low, high of the windows in segments of hot seeds that occur in an earlier place too.

    The earliest place of a window is combined before the shuffle, and the join with it is one of
    stored tables, so neither a hot seed nor a hot window is held anywhere.
    """
    spark = hot.sparkSession

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out = []
            for id_, cls, starts, content in zip(*(c.to_pylist() for c in batch.columns)):
                symbols = content if unit.kind == "byte" else content.split()
                for k in range(len(symbols) - unit.window + 1):
                    own = symbols[k : k + unit.window]
                    digest = hashlib.md5(own if unit.kind == "byte" else b" ".join(own)).digest()
                    out.extend((digest, id_, cls, start + k) for start in starts)
                if len(out) >= 1 << 16:
                    yield _columns(out, types, ["digest", "id", "cls", "low"])
                    out = []
            yield _columns(out, types, ["digest", "id", "cls", "low"])

    hot.mapInArrow(windows, "digest binary, id bigint, cls bigint, low bigint").write.parquet(f"{folder}/windows")
    found = spark.read.parquet(f"{folder}/windows")
    place = F.struct("id", "cls", "low") if within_document else F.struct("id")
    least = found.groupBy("digest").agg(F.min(place).alias("least"), F.max(place).alias("last"))
    least.filter("least < last").select("digest", "least").write.parquet(f"{folder}/least")
    later = found.join(spark.read.parquet(f"{folder}/least"), "digest").filter(place > F.col("least"))
    return later.select("id", "cls", "low", (F.col("low") + unit.window).alias("high"))


def _columns(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(types), types)], names=names)


def segments_of(rows: DataFrame, unit: Unit, within_document: bool, collapse: bool = True) -> DataFrame:
    """The segments of all repeated seeds, brought together and sorted by seed."""
    candidates = _repeated(rows, unit)
    firsts = rows.groupBy("cls").agg(F.min("id").alias("id"))
    wanted = candidates.join(firsts, "cls")
    folder = work_folder(rows.sparkSession, "passages")
    wanted.write.parquet(folder)
    wanted = rows.sparkSession.read.parquet(folder)
    texts = (
        sifted(rows, "id", wanted.select("id"))
        .join(wanted, ["id", "cls"])
        .dropDuplicates(["id", "cls"])
        .select("id", "cls", "text", "numbers")
    )
    schema = "seed bigint, id bigint, cls bigint, starts array<bigint>, size bigint, content binary"
    segments = texts.mapInArrow(_segments(unit, within_document, collapse), schema)
    # Stretches known to be covered have no content and a seed of their own: they pass through.
    return segments.repartition("seed").sortWithinPartitions("seed", "id", "cls")


def _repeated(rows: DataFrame, unit: Unit) -> DataFrame:
    """cls, numbers: which seeds of which text classes occur in another place as well."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per seed: hash and number, class and a mark.

        Of a seed that occurs several times in a batch one row goes where the hash goes;
        the others are already known to repeat and are dealt out at random.
        """
        for classes, texts in together(batches):
            hashes, numbers, of = [], [], []
            for cls, text in dict(zip(classes, texts)).items():
                found = unit.seeds(text.encode()).hashes
                hashes.append(found)
                numbers.append(np.arange(len(found), dtype="u8"))
                of.append(np.full(len(found), cls, "i8"))
            if not hashes:
                continue
            hash_, number, cls = map(np.concatenate, (hashes, numbers, of))
            number &= np.uint64((1 << NUMBER_BITS) - 1)
            _, first, counts = np.unique(hash_, return_index=True, return_counts=True)
            known = np.ones(len(hash_), bool)
            known[first] = counts > 1
            away = np.ones(len(hash_), bool)
            away[first] = False
            key = np.where(away, mixed(hash_ ^ cls.view("u8") ^ (number << np.uint64(40))), hash_)
            key = (key & ~np.uint64((1 << NUMBER_BITS) - 1)) | number
            mark = ((cls.view("u8") >> np.uint64(1)) << np.uint64(1)) | known.astype("u8")
            yield pa.record_batch([pa.array(key.view("i8")), pa.array(mark.view("i8"))], names=["key", "mark"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key: keep those whose seed has two places or is known to repeat."""
        held = (np.zeros(0, "u8"), np.zeros(0, "u8"))

        def kept(key: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
            seed = key >> np.uint64(NUMBER_BITS)
            first = np.flatnonzero(np.append(True, seed[1:] != seed[:-1])) if len(seed) else seed
            if not len(first):
                return pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.int32())], names=["half", "number"])
            known = np.maximum.reduceat(mark & np.uint64(1), first) > 0
            cls = mark >> np.uint64(1)
            several = np.minimum.reduceat(cls, first) != np.maximum.reduceat(cls, first)
            several |= np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first)
            stay = np.repeat(known | several, np.diff(np.append(first, len(seed))))
            number = (key[stay] & np.uint64((1 << NUMBER_BITS) - 1)).astype("i4")
            return pa.record_batch([pa.array(cls[stay].view("i8")), pa.array(number)], names=["half", "number"])

        for batch in batches:
            key = np.concatenate([held[0], batch.column(0).to_numpy().view("u8")])
            mark = np.concatenate([held[1], batch.column(1).to_numpy().view("u8")])
            if not len(key):
                continue
            seed = key >> np.uint64(NUMBER_BITS)
            others = np.flatnonzero(seed != seed[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield kept(key[:cut], mark[:cut])
            held = (key[cut:], mark[cut:])
        yield kept(*held)

    seed_of = F.shiftright("key", NUMBER_BITS)
    repeated = (
        rows.select("cls", "text")
        .mapInArrow(emit, "key bigint, mark bigint")
        .repartition(seed_of)
        .sortWithinPartitions("key")
        .mapInArrow(scan, "half bigint, number int")
    )
    numbers = repeated.groupBy("half").agg(F.collect_set("number").alias("numbers"))
    classes = rows.select("cls").distinct().withColumn("half", F.shiftrightunsigned("cls", 1))
    return numbers.join(classes, "half").select("cls", "numbers")


def _segments(unit: Unit, within_document: bool, collapse: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments of the wanted seeds; equal contents of a batch leave it once.

        Of equal contents all but the earliest place (or document) are covered as a whole.
        """
        for docs in rows_together(batches, 2):
            docs.sort(key=lambda r: r[:2])
            first: dict[bytes, list] = {}
            out = []
            for id_, cls, text, numbers in docs:
                raw = text.encode()
                found = unit.seeds(raw)
                wanted = np.isin(np.arange(len(found.hashes)) & ((1 << NUMBER_BITS) - 1), numbers)
                covered = []
                for k in np.flatnonzero(wanted).tolist():
                    low, high = int(found.first[k]), int(found.last[k]) + unit.window
                    content = raw[low:high] if found.starts is None else raw[found.starts[low] : found.ends[high - 1]]
                    own = first.get(content) if collapse else None
                    if not collapse:
                        out.append((int(found.hashes[k].view("i8")), id_, cls, [low], high - low, content))
                    elif own is None:
                        first[content] = [int(found.hashes[k].view("i8")), id_, cls, [low], high - low]
                    elif not within_document and (own[1], own[2]) == (id_, cls):
                        own[3].append(low)
                    elif within_document or own[1] < id_:
                        covered.append((low, high))
                    else:  # one id with two texts: neither is earlier, so both go on
                        out.append((int(found.hashes[k].view("i8")), id_, cls, [low], high - low, content))
                for low, high in merged(covered):
                    out.append((int(mixed(np.array([hash((id_, cls, low)) & LAST], "u8"))[0].view("i8")), id_, cls, [low], high - low, None))
            out += [(*own, content) for content, own in first.items()]
            for at in range(0, len(out), 4096):
                yield _rows_of(out[at : at + 4096])

    def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        names = ["seed", "id", "cls", "starts", "size", "content"]
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return run


def _indexed(index: Callable[[list[Segment]], Covered], within_document: bool):
    names = ["id", "cls", "low", "high", "starts", "content"]
    types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by seed. Whole seeds are gathered until they make up an index.

        Rows out are covered stretches, or segments of seeds that are too hot for an index.
        """
        held: list[Segment] = []
        size, spans = 0, []
        seed, own, own_size = None, {}, 0
        hot, passed = False, []

        def close_seed() -> None:
            nonlocal own, own_size, size, hot
            if len(own) > 1:  # a single content has no other place where it may be found
                held.extend(own.values())
                size += own_size
            own, own_size, hot = {}, 0, False

        def covered(segment: Segment, low: int = 0, high: int | None = None) -> None:
            high = segment.size if high is None else high
            spans.extend((segment.doc, segment.cls, s + low, s + high) for s in segment.starts.tolist())

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, spans
            for k, low, high in index(held) if held else ():
                covered(held[k], low, high)
            by_doc: dict[tuple, list] = {}
            for id_, cls, low, high in spans:
                by_doc.setdefault((id_, cls), []).append((low, high))
            out = [(*doc, *stretch, None, None) for doc, stretches in by_doc.items() for stretch in merged(stretches)]
            yield _columns(out, types, names)
            held, size, spans = [], 0, []

        def let_go() -> pa.RecordBatch:
            nonlocal passed
            out = [(s.doc, s.cls, None, None, s.starts.tolist(), s.content) for s in passed]
            passed = []
            return _columns(out, types, names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for s, id_, cls, starts, n, content in zip(*columns):
                segment = Segment(content, id_, cls, np.array(starts), n)
                if content is None:
                    covered(segment)
                    continue
                if s != seed:
                    close_seed()
                    seed = s
                    if size >= INDEX_BYTES or len(spans) > 100_000:
                        yield from flush()
                if hot:
                    passed.append(segment)
                    continue
                # Rows come in order of id, so the first with a content is the earliest.
                earlier = own.setdefault((content, 0), segment)
                if earlier is not segment:
                    if earlier.doc < id_ or within_document:
                        covered(segment)
                        continue
                    own[content, len(own)] = segment
                own_size += len(content)
                if own_size > INDEX_BYTES:
                    passed.extend(own.values())
                    own, own_size, hot = {}, 0, True
            if passed:
                yield let_go()
        close_seed()
        yield from flush()

    return run


def rows_together(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[list[tuple]]:
    """Rows as tuples, as many at a time as make up TOGETHER characters in the text column."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            size += len(row[text])
            if size >= TOGETHER:
                yield held
                held, size = [], 0
    if held:
        yield held


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of stretches, as few as there are."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def with_digest(
    docs: DataFrame, unit: Unit, id_column: str, text_column: str
) -> tuple[DataFrame, DataFrame]:
    """id, cls, text of all rows, and per row id, cls, symbols, md5 and kept_sha256 if nothing goes."""
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("cls", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "cls", "symbols", "md5", "sha256"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        for batch in batches:
            out = []
            for id_, cls, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                digest = hashlib.md5(raw).digest()
                if unit.kind == "byte":
                    out.append((id_, cls, len(raw), digest, hashlib.sha256(raw).hexdigest()))
                else:
                    own = raw.split()
                    out.append((id_, cls, len(own), digest, hashlib.sha256(b" ".join(own)).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "id bigint, cls bigint, symbols bigint, md5 binary, sha256 string"
    return rows, rows.select("id", "cls", "text").mapInArrow(run, schema)


def without_covered(
    docs: DataFrame,
    unit: Unit,
    index: Callable[[list[Segment]], Covered],
    within_document: bool,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of docs: doc_id, symbols, n_removed, n_spans, kept_sha256.

    Equal texts form a class whose smallest id stands for it. A later copy is covered whole
    if it has a window at all, so copies take no further part. What is left of a word text is
    its kept words joined by single spaces; of a byte text the bytes that remain.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "covered")
    rows, digests = with_digest(docs, unit, id_column, text_column)
    digests.write.parquet(f"{folder}/digests")
    digests = spark.read.parquet(f"{folder}/digests")
    spans = covered_spans(rows.select("id", "cls", "text"), unit, index, within_document)
    spans.write.parquet(f"{folder}/spans")
    spans = spark.read.parquet(f"{folder}/spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "cls", "removed", "n_spans", "left_sha256"]
        types = [pa.int64()] * 4 + [pa.string()]
        for batch in batches:
            out = []
            for id_, cls, text, stretches in zip(*(c.to_pylist() for c in batch.columns)):
                gone = merged([(s["low"], s["high"]) for s in stretches])
                raw = text.encode()
                symbols = raw if unit.kind == "byte" else raw.split()
                left, at = [], 0
                for low, high in gone:
                    left.append(symbols[at:low])
                    at = high
                left.append(symbols[at:])
                kept = b"".join(left) if unit.kind == "byte" else b" ".join(w for part in left for w in part)
                out.append((id_, cls, sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    affected = sifted(rows, "id", spans.select("id")).join(spans, ["id", "cls"]).select("id", "cls", "text", "spans")
    changed = affected.mapInArrow(
        cut, "id bigint, cls bigint, removed bigint, n_spans bigint, left_sha256 string"
    ).dropDuplicates(["id", "cls"])
    # Stored, so that the join is one of two tables, whose hot digests are split at run time.
    digests.groupBy("md5").agg(F.min("id").alias("least")).write.parquet(f"{folder}/least")
    least = spark.read.parquet(f"{folder}/least")
    nothing = hashlib.sha256(b"").hexdigest()
    copy = (F.col("id") > F.col("least")) & (F.col("symbols") >= unit.window)
    return (
        digests.join(least, "md5")
        .join(changed, ["id", "cls"], "left")
        .select(
            F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"),
            "symbols",
            F.when(copy, F.col("symbols")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
            F.when(copy, F.lit(nothing)).otherwise(F.coalesce("left_sha256", "sha256")).alias("kept_sha256"),
        )
    )
