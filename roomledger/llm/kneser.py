"""Quality by perplexity: an interpolated modified Kneser-Ney model of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.session import work_folder

# A gram of ORDER symbols of BITS bits each is one integer.
ORDER, BITS = 4, 16
SYMBOLS = 1 << BITS
# Code points above the basic plane share the codes of surrogates and private use, which text has not.
SHARED, SHARED_SIZE = 0xD800, 0x2100
# Trusted ids are marked in words of 64; so many words are broadcast at most, more are joined by shuffle.
MOST_WORDS = 1_000_000
# A text is rejected if its bits per symbol are above this quantile of trusted texts that its model has not seen.
QUANTILE = 0.99
# The model of all trusted texts is 0, those of the two halves are 1 and 2. A row holds all three.
MODELS = (0, 1, 2)
# So many symbols of usual text are added to each, so that a short one is not judged by chance.
PRIOR = 16
# Documents whose ids share this quotient ask for probabilities together.
BLOCK_IDS = 8192
# Texts longer than this many characters have blocks of fewer ids, so that a block holds about
# BLOCK_IDS * BLOCK_CHARS characters at most, or one text.
BLOCK_CHARS = 1 << 12
# Symbols worked on at once, and grams held before they are merged.
PIECE, HELD = 1 << 20, 1 << 21
# So many grams, those that most blocks ask for, are broadcast with their bits (32 bytes each) and
# asked for no more; all others go by shuffle.
COMMON = 1 << 18
# Characters of texts that are packed together before they are shuffled.
PACKED = 1 << 22
# Blocks that rows without id are dealt over.
UNNAMED_BLOCKS = 256


def grams_of(text: str) -> Iterator[np.ndarray]:
    """The grams of a text, one ending at each character; in front of it stand zeros.

    A character of the basic plane is itself, so every script has its own symbols.
    """
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "u4")
    for start in range(0, len(raw), PIECE):
        low = max(0, start - ORDER + 1)
        part = raw[low : start + PIECE]
        part = np.where(part < SYMBOLS, np.maximum(part, 1), part % SHARED_SIZE + SHARED)
        if start == 0:
            part = np.concatenate([np.zeros(ORDER - 1, "u4"), part])
        size = len(part) - ORDER + 1
        found = np.zeros(size, "u8")
        for k in range(ORDER):
            found = (found << np.uint64(BITS)) | part[k : k + size].astype("u8")
        yield found


class Tally:
    """Counts of grams by key, merged when many are held: bounded by the grams there are."""

    def __init__(self) -> None:
        self.held: dict[tuple, list[np.ndarray]] = {}
        self.size: dict[tuple, int] = {}
        self.done: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, key: tuple, grams: np.ndarray) -> None:
        self.held.setdefault(key, []).append(grams)
        self.size[key] = self.size.get(key, 0) + len(grams)
        if self.size[key] >= HELD:
            self.merge(key)

    def merge(self, key: tuple) -> tuple[np.ndarray, np.ndarray]:
        new, counts = np.unique(np.concatenate(self.held.pop(key, [np.zeros(0, "u8")])), return_counts=True)
        old, before = self.done.get(key, (np.zeros(0, "u8"), np.zeros(0, "i8")))
        both = np.concatenate([old, new])
        grams, inverse = np.unique(both, return_inverse=True)
        total = np.bincount(inverse, np.concatenate([before, counts]), len(grams)).astype("i8")
        self.done[key], self.size[key] = (grams, total), 0
        return self.done[key]

    def keys(self) -> list[tuple]:
        return list({**self.done, **self.held})

    def full(self) -> bool:
        """Whether many grams are held over all keys, also after they are merged."""
        if sum(self.size.values()) + sum(len(g) for g, _ in self.done.values()) < 2 * HELD:
            return False
        return sum(len(self.merge(key)[0]) for key in self.keys()) >= HELD


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows block, lang, half, text, trusted: the grams each block asks for, and trusted counts.

    Requests have half 0, trusted counts have no block. Both are merged over the task, as far as
    it can hold them, before they leave it.
    """
    tally = Tally()
    for batch in batches:
        added = 0
        for block, lang, half, text, trusted in zip(*(c.to_pylist() for c in batch.columns)):
            for grams in grams_of(text):
                tally.add((block, lang, 0), grams)
                if trusted:
                    tally.add((None, lang, half), grams)
                added += len(grams)
            if added >= PIECE:
                added = 0
                if tally.full():
                    yield from _tallied(tally)
                    tally = Tally()
        if len(tally.keys()) > 256:  # ids in no order: blocks are let go, not piled up
            yield from _tallied(tally)
            tally = Tally()
    yield from _tallied(tally)


def _tallied(tally: Tally) -> Iterator[pa.RecordBatch]:
    for key in tally.keys():
        grams, counts = tally.merge(key)
        n = len(grams)
        yield pa.record_batch(
            [
                pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.string()),
                pa.array([key[2]] * n, pa.int32()), pa.array(grams.view("i8")), pa.array(counts),
            ],
            names=["block", "lang", "half", "gram", "n"],
        )


_TEXTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("text", pa.string())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows block, lang, half, doc_id, text_hash, text: the texts of each key together, compressed."""
    held: dict[tuple, list[tuple]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (block, lang, half), texts in held.items():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
            with pa.ipc.new_stream(sink, _TEXTS, options=options) as out:
                out.write_batch(pa.record_batch([pa.array(c, t) for c, t in zip(zip(*texts), _TEXTS.types)], schema=_TEXTS))
            yield pa.record_batch(
                [
                    pa.array([block], pa.int64()), pa.array([lang], pa.string()), pa.array([half], pa.int32()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                names=["block", "lang", "half", "texts"],
            )

    for batch in batches:
        for block, lang, half, doc, hash_, text in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault((block, lang, half), []).append((doc, hash_, text))
            size += len(text)
            if size >= PACKED:
                yield from flush()
                held, size = {}, 0
    yield from flush()


# Grams with their bits by the three models.
Bits = list[np.ndarray]


def _by_lang(common: pa.Table) -> dict[str, Bits]:
    """The common grams of each language as arrays."""
    coded = common.column("lang").combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()
    columns = [common.column(c).to_numpy() for c in ("gram", "bits0", "bits1", "bits2")]
    return {lang: [c[codes == k] for c in columns] for k, lang in enumerate(coded.dictionary.to_pylist())}


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, bool, int, int]]:
    """Key, whether they are grams, start and end of the runs of rows that are a group's grams, or its texts."""
    given = batch.column("gram").is_valid().to_numpy(zero_copy_only=False)
    n = len(given)
    if not n:
        return
    changes = given[1:] != given[:-1]
    for name in keys:
        column = batch.column(name)
        changes = changes | pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
    for start, end in zip(edges, edges[1:]):
        yield tuple(batch.column(name)[start].as_py() for name in keys), bool(given[start]), start, end


def _unpacked(batches: Iterator[pa.RecordBatch], common: dict[str, Bits]) -> Iterator[pa.RecordBatch]:
    """What _scored takes: for each half of a block and language its grams, then its texts.

    Rows of a block and language come together: grams with the bits of three models, then texts
    by half. A gram may come several times, once from each task that asked for it; common ones
    do not come.
    """
    names = ["block", "lang", "half", "gram", "whole", "unseen", "doc_id", "text_hash", "text"]
    key, half, held, known = None, None, [], None

    def rows(n: int, **columns) -> pa.RecordBatch:
        filled = {"block": pa.repeat(pa.scalar(key[0], pa.int64()), n), "lang": pa.repeat(pa.scalar(key[1], pa.string()), n)}
        filled |= {"half": pa.repeat(pa.scalar(half, pa.int32()), n), **columns}
        types = {"gram": pa.int64(), "whole": pa.float64(), "unseen": pa.float64(), **dict(zip(_TEXTS.names, _TEXTS.types))}
        return pa.record_batch([filled[c] if c in filled else pa.nulls(n, types[c]) for c in names], names=names)

    for batch in batches:
        for own, given, start, end in _runs(batch, ["block", "lang"]):
            if key != own:
                key, half, held, known = own, None, [], None
            if given:
                part = batch.slice(start, end - start)
                held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "bits0", "bits1", "bits2")])
                continue
            if known is None:
                held.append(common.get(key[1], [np.zeros(0, "i8"), *[np.zeros(0)] * 3]))
                columns = [np.concatenate(c) for c in zip(*held)]
                _, first = np.unique(columns[0], return_index=True)
                known, held = [c[first] for c in columns], []
            for k in range(start, end):
                if half != batch.column("half")[k].as_py():
                    half = batch.column("half")[k].as_py()
                    gram, whole, unseen = known[0], known[1], known[1 + (3 - half)]
                    yield rows(len(gram), gram=pa.array(gram), whole=pa.array(whole), unseen=pa.array(unseen))
                with pa.ipc.open_stream(batch.column("texts")[k].as_buffer()) as packs:
                    for texts in packs:
                        yield rows(len(texts), **{c: texts.column(c) for c in _TEXTS.names})


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, language and half come together: first its grams' bits, then its texts.

    Bits are those of the whole model and of the model that has not seen the half.
    """
    key, held, known = None, [], None
    names = ["doc_id", "lang", "text_hash", "symbols", "bits", "unseen"]
    for batch in batches:
        out = []
        texts = batch.select(["doc_id", "text_hash", "text"])
        for own, given, start, end in _runs(batch, ["block", "lang", "half"]):
            if key != own:
                key, held, known = own, [], None
            lang = key[1]
            if given:
                part = batch.slice(start, end - start)
                held.append([part.column(name).to_numpy(zero_copy_only=False) for name in ("gram", "whole", "unseen")])
                continue
            if known is None:
                columns = [np.concatenate(c) for c in zip(*held)] or [np.zeros(0, "i8"), np.zeros(0), np.zeros(0)]
                order = np.argsort(columns[0])
                known = columns[0][order], np.stack([columns[1][order], columns[2][order]], axis=1)
                held = []
            out += _bits(texts.slice(start, end - start), lang, known)
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = list(zip(*out)) or [()] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _bits(texts: pa.RecordBatch, lang: str, known: tuple[np.ndarray, np.ndarray]) -> list[tuple]:
    """doc_id, lang, text_hash, symbols and the two sums of bits of each text."""
    out = []
    for doc, hash_, text in zip(*(c.to_pylist() for c in texts.columns)):
        total, symbols = np.zeros(2), 0
        for found in grams_of(text):
            distinct, counts = np.unique(found.view("i8"), return_counts=True)
            total += counts @ known[1][np.searchsorted(known[0], distinct)]
            symbols += len(found)
        out.append((doc, lang, hash_, symbols, *total.tolist()))
    return out


def _probabilities(wanted: DataFrame, counts: DataFrame, folder: str) -> DataFrame:
    """lang, gram, p0, p1, p2 of each wanted gram by the three models, order by order from the shortest.

    wanted: lang, gram, stored; counts: lang, gram, n0, n1, n2. A gram is one row for all models.
    The counts of the longest grams are those of the text; of a shorter one, the different
    symbols that stand before it. Three discounts per order come from the counts of counts.
    What they take off is given to the next shorter order. A context never seen leaves
    all to it; below single symbols stands the even distribution.
    """

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return frame.sparkSession.read.parquet(f"{folder}/{name}")

    # Each order is a table of its own: plans stay small, and a lost task repeats little.
    own, asked = {ORDER: stored(counts, f"counts{ORDER}")}, {ORDER: wanted}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")
        before = [F.count_if(F.col(f"n{m}") > 0).alias(f"n{m}") for m in MODELS]
        own[order] = stored(own[order + 1].groupBy("lang", suffix).agg(*before), f"counts{order}")
        asked[order] = stored(asked[order + 1].select("lang", suffix).distinct(), f"wanted{order}")

    even = [F.lit(1.0 / SYMBOLS).alias(f"p{m}") for m in MODELS]
    lower = asked[1].select("lang", F.lit(0).cast("bigint").alias("gram"), *even).distinct()
    for order in range(1, ORDER + 1):
        seen = own[order]
        tally = seen.groupBy("lang").agg(
            *[F.count_if(F.col(f"n{m}") == k).cast("double").alias(f"t{m}{k}") for m in MODELS for k in (1, 2, 3, 4)]
        )

        def discount(m: int, k: int) -> Column:
            t = {j: F.col(f"t{m}{j}") for j in (1, 2, 3, 4)}
            y = t[1] / F.greatest(t[1] + 2 * t[2], F.lit(1.0))
            off = k - (k + 1) * y * t[k + 1] / F.greatest(t[k], F.lit(1.0))
            return F.greatest(F.lit(0.01), F.least(F.lit(k - 0.01), off)).alias(f"d{m}{k}")

        discounts = F.broadcast(tally.select("lang", *[discount(m, k) for m in MODELS for k in (1, 2, 3)]))
        prefix = F.shiftrightunsigned("gram", BITS)
        sums = [F.sum(f"n{m}").alias(f"total{m}") for m in MODELS]
        kinds = [
            F.count_if(F.col(f"n{m}") == k if k < 3 else F.col(f"n{m}") >= k).alias(f"k{m}{k}")
            for m in MODELS
            for k in (1, 2, 3)
        ]
        contexts = (
            seen.groupBy("lang", prefix.alias("prefix")).agg(*sums, *kinds).join(discounts, "lang").select(
                "lang", "prefix", *[f"total{m}" for m in MODELS],
                *[sum((F.col(f"d{m}{k}") * F.col(f"k{m}{k}") for k in (1, 2, 3)), F.lit(0.0)).alias(f"rest{m}") for m in MODELS],
            )
        )
        suffix = F.col("gram").bitwiseAND((1 << BITS * (order - 1)) - 1)
        rows = (
            asked[order]
            .withColumn("prefix", prefix)
            .withColumn("suffix", suffix)
            .join(seen, ["lang", "gram"], "left")
            .join(contexts, ["lang", "prefix"], "left")
            .join(lower.withColumnRenamed("gram", "suffix"), ["lang", "suffix"])
            .join(discounts, "lang", "left")
        )

        def probability(m: int) -> Column:
            n, total, below = F.col(f"n{m}"), F.col(f"total{m}"), F.col(f"p{m}")
            off = F.when(n == 1, F.col(f"d{m}1")).when(n == 2, F.col(f"d{m}2")).otherwise(F.col(f"d{m}3"))
            kept = F.when(n > 0, n - off).otherwise(F.lit(0.0))
            return F.when(total > 0, (kept + F.col(f"rest{m}") * below) / total).otherwise(below).alias(f"p{m}")

        lower = stored(rows.select("lang", "gram", *map(probability, MODELS)), f"p{order}")
    return lower


def perplexities(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per document: doc_id, lang, text_hash, symbols, bits_per_symbol, perplexity, unseen_bits, threshold, kept.

    Trusted are the documents with labels.quality = 1; all of them train the models of their
    language. Documents ask in blocks: a block's distinct
    grams are joined with the sharded counts, order by order, and the answers meet its
    texts, which are shuffled once, compressed, and streamed. No task or broadcast holds the model:
    the COMMON grams that most blocks ask for are broadcast, at most 8 MB of them.

    No document is judged by a model that has seen its text: texts fall into two halves by
    their hash, and each half has unseen_bits per symbol by the model of the other half's
    trusted texts. A document is rejected if they exceed threshold, the QUANTILE of all trusted
    documents of its language. A language with trusted texts in one half only, or without
    trusted documents, rejects none. bits_per_symbol and perplexity are by the model of both halves.
    NULL or empty text has no symbols, no perplexity, and is kept. NULL lang is a language
    of its own (empty name). NULL and repeated ids are rows like others, never trusted if
    NULL. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "quality")
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang"),
    )
    # A block is ids of one quotient and texts of one class of length; rows without id are dealt out.
    level = F.least(F.length(F.bin(F.floor(F.length("text") / BLOCK_CHARS).cast("bigint"))), F.lit(BLOCK_IDS.bit_length())) - 1
    quotient = F.floor(F.col("doc_id") * F.pow(F.lit(2.0), level) / BLOCK_IDS)
    unnamed = F.pmod(F.xxhash64("text"), F.lit(UNNAMED_BLOCKS))
    block = F.xxhash64(level, F.col("doc_id").isNull(), F.coalesce(quotient, unnamed))
    rows = rows.withColumn("block", block).withColumn("half", (1 + F.pmod(F.xxhash64("text"), F.lit(2))).cast("int"))
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("trusted_id")).distinct()
    word = F.shiftright("trusted_id", 6).alias("word")
    marks = trusted.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(trusted_id & 63 as int))")).alias("marks"))
    marks.write.parquet(f"{folder}/trusted")
    marks = spark.read.parquet(f"{folder}/trusted")
    if marks.count() <= MOST_WORDS:
        marks = F.broadcast(marks)

    marked = rows.withColumn("word", F.shiftright("doc_id", 6)).join(marks, "word", "left")
    is_trusted = F.expr("coalesce(shiftrightunsigned(marks, cast(doc_id & 63 as int)) & 1, 0) = 1")
    marked.select("block", "lang", "half", "text", is_trusted.alias("trusted")).mapInArrow(
        _gathered, "block bigint, lang string, half int, gram bigint, n bigint"
    ).write.option("compression", "zstd").parquet(f"{folder}/grams")
    gathered = spark.read.parquet(f"{folder}/grams")

    of_half = [F.sum(F.when(F.col("half") == m, F.col("n")).otherwise(0)).alias(f"n{m}") for m in (1, 2)]
    counts = gathered.filter("block is null").groupBy("lang", "gram").agg(F.sum("n").alias("n0"), *of_half)
    requests = gathered.filter("block is not null").select("block", "lang", "gram")
    asks = requests.groupBy("lang", "gram").agg(F.count("*").alias("asks"))
    asks.write.option("compression", "zstd").parquet(f"{folder}/wanted")
    wanted = spark.read.parquet(f"{folder}/wanted")
    bits = _probabilities(wanted.select("lang", "gram"), counts, folder).select(
        "lang", "gram", *[(-F.log2(f"p{m}")).alias(f"bits{m}") for m in MODELS]
    )
    # What most blocks ask for is not sent to each of them by shuffle.
    wanted.filter("asks > 1").orderBy(F.desc("asks"), "lang", "gram").limit(COMMON).select("lang", "gram").write.parquet(
        f"{folder}/common"
    )
    usual = F.broadcast(spark.read.parquet(f"{folder}/common"))
    common = spark.sparkContext.broadcast(_by_lang(bits.join(usual, ["lang", "gram"]).toArrow()))
    asked = requests.join(usual, ["lang", "gram"], "left_anti").join(bits, ["lang", "gram"]).select(
        "block", "lang", F.lit(None).cast("int").alias("half"), "gram", *[f"bits{m}" for m in MODELS],
        F.lit(None).cast("binary").alias("texts"),
    )
    # Texts travel once, compressed with their neighbours.
    packs = rows.select("block", "lang", "half", "doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _packed, "block bigint, lang string, half int, texts binary"
    )
    packs = packs.select(
        "block", "lang", "half", F.lit(None).cast("bigint").alias("gram"),
        *[F.lit(None).cast("double").alias(f"bits{m}") for m in MODELS], "texts",
    )
    order = ["block", "lang", F.col("gram").asc_nulls_last(), "half"]
    asked.unionByName(packs).repartition("block", "lang").sortWithinPartitions(*order).mapInArrow(
        lambda batches: _scored(_unpacked(batches, common.value)),
        "doc_id bigint, lang string, text_hash bigint, symbols bigint, bits double, unseen double",
    ).write.parquet(f"{folder}/scores")
    scores = spark.read.parquet(f"{folder}/scores")

    each = F.when(F.col("symbols") > 0, F.col("bits") / F.col("symbols"))
    unseen = F.when(F.col("symbols") > 0, F.col("unseen") / F.col("symbols"))
    (
        scores.join(trusted, F.col("doc_id") == F.col("trusted_id"), "left_semi")
        .groupBy("lang")
        .agg(
            F.percentile_approx(unseen, QUANTILE, 10_000).alias("threshold"),
            F.percentile_approx(unseen, 0.5, 10_000).alias("usual"),
        )
        .write.parquet(f"{folder}/usual")
    )
    # Stored, so that its size is known: it is broadcast if small, else hot languages are split.
    by_lang = spark.read.parquet(f"{folder}/usual")
    judged = (F.col("unseen") + PRIOR * F.col("usual")) / (F.col("symbols") + PRIOR)
    return scores.join(by_lang, "lang", "left").select(
        "doc_id",
        "lang",
        "text_hash",
        "symbols",
        each.alias("bits_per_symbol"),
        F.pow(F.lit(2.0), each).alias("perplexity"),
        unseen.alias("unseen_bits"),
        "threshold",
        F.coalesce((F.col("symbols") == 0) | (judged <= F.col("threshold")), F.lit(True)).alias("kept"),
    )


def drop_unlike_trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rejected = perplexities(docs, labels).filter("not kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    ).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col("_hash")
    )
    return docs.join(rejected, same, "left_anti")
