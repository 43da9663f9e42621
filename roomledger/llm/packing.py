"""Order-preserving packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.rolling import joined, together, words

# Chunks whose ids a Python worker remembers at once.
REMEMBERED = 2_000_000
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Tokens packed at once; a sequence is never longer than the window below it.
BLOCK = 1 << 19
# Cost of a cut, in tokens of padding.
AT_SENTENCE, INSIDE = 4, 24
# Sentence ends closer than this count as one; without any, a cut is allowed at this distance.
NEAR, FAR = 32, 128

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class WordTokens:
    """Ids of texts under a tokenizer that drops white space and ends words by a mark.

    Space-separated chunks are encoded by the tokenizers library, each distinct one once:
    neither normalisation nor pre-splitting of such a tokenizer looks past white space.
    Letters followed by punctuation are two pieces, since its pattern parts them.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, id_ in vocabulary.items():
            self.ends[id_] = token.endswith("</w>")
        marks = (".</w>", "!</w>", "?</w>", "...</w>")
        self.stops = np.array([vocabulary[m] for m in marks if m in vocabulary], "u4")
        self.kind = "u2" if len(self.ends) < 65536 else "u4"
        self._forget()

    def _forget(self) -> None:
        # Known chunks: sorted hashes, and the place and number of each one's ids.
        self.keys, self.place = np.zeros(0, "u8"), np.zeros(0, "i4")
        self.count, self.ids = np.zeros(0, "i4"), np.zeros(0, self.kind)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts, and where each text's ids start (and the last ones end)."""
        data, starts = joined([t.encode().lower() for t in texts])
        found = words(data, lower=False)
        distinct, first, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
        at = self._find(distinct)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            if len(self.keys) + len(unknown) > REMEMBERED:
                self._forget()
                unknown = np.arange(len(distinct))
            raw = data.tobytes()
            low, high = found.starts[first[unknown]].tolist(), found.ends[first[unknown]].tolist()
            self._learn(distinct[unknown], [raw[a:b].decode() for a, b in zip(low, high)])
            at = self._find(distinct)
        at = at[inverse]
        counts = self.count[at]
        ends = np.cumsum(counts, dtype="i8")
        take = np.arange(ends[-1] if len(ends) else 0)
        take += np.repeat(self.place[at] - (ends - counts), counts)
        edges = np.append(0, ends)[np.searchsorted(found.starts, starts)]
        return self.ids[take], edges

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, hashes)
        if not len(self.keys):
            return np.full(len(hashes), -1)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == hashes
        return np.where(known, at, -1)

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        """Add the ids of chunks whose hashes are given in ascending order."""
        bases = [c.rstrip(PUNCTUATION) for c in chunks]
        lone = [b.isalpha() for b in bases]
        letters = list({b for b, ok in zip(bases, lone) if ok})
        rest = list({c[len(b) :] if ok else c for c, b, ok in zip(chunks, bases, lone)})
        of = dict(zip(letters, self._letters(letters)))
        some = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        other = {c: e.ids for c, e in zip(rest, some)}
        ids = [
            of[b] + other[c[len(b) :]] if ok else other[c] for c, b, ok in zip(chunks, bases, lone)
        ]
        counts = np.array(list(map(len, ids)), "i4")
        flat = np.array([i for own in ids for i in own], self.kind)
        place = (len(self.ids) + np.cumsum(counts) - counts).astype("i4")
        self.ids = np.concatenate([self.ids, flat])
        where = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, where, hashes)
        self.place = np.insert(self.place, where, place)
        self.count = np.insert(self.count, where, counts)

    def _letters(self, words_: list[str]) -> list[list[int]]:
        """Runs of letters are one word each, so their ids part at the marked ends."""
        found: list[list[int]] = []
        for at in range(0, len(words_), 1000):
            some = words_[at : at + 1000]
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ends = (np.flatnonzero(self.ends[np.array(ids, "i4")]) + 1).tolist()
            if len(ends) == len(some):
                found += [ids[a:b] for a, b in zip([0, *ends], ends)]
            else:
                found += [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return found


@lru_cache(maxsize=2)
def word_tokens(file: str) -> WordTokens:
    return WordTokens(file)


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts in a block, ascending from 0 to its end, and the cost of each."""
    cost = np.full(len(ids) + 1, -1, "i4")
    cost[FAR:-1:FAR] = INSIDE
    sentence = np.flatnonzero(np.isin(ids, stops)) + 1
    if len(sentence):
        apart = np.flatnonzero(np.diff(sentence // NEAR, prepend=-1))
        cost[sentence[apart]] = AT_SENTENCE
    cost[doc_ends] = 0
    cost[0] = cost[-1] = 0
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, cost: np.ndarray, window: int) -> list[int]:
    """Cuts from the first to the last place with the least padding plus cut costs.

    best[j] is the least cost up to place j. The padding of a sequence from i to j is
    window - (p[j] - p[i]), so the best i in reach has the smallest best[i] + p[i]: a
    monotone queue keeps it. A length that is a power of two needs no padding; those few
    predecessors are looked up beside the queue, at a small cost that favours full ones.
    """
    n = len(places)
    by_power: dict[int, list[tuple[int, int]]] = {}
    for power in range(window.bit_length()):
        at = np.searchsorted(places, places - (1 << power))
        for j in np.flatnonzero(places[np.minimum(at, n - 1)] == places - (1 << power)).tolist():
            by_power.setdefault(j, []).append((int(at[j]), (window - (1 << power)) // 128))
    p, c = places.tolist(), cost.tolist()
    best, back = [0] * n, [0] * n
    queue = deque([0])
    value = [0] * n
    value[0] = p[0]
    for j in range(1, n):
        reach = p[j] - window
        while p[queue[0]] < reach:
            queue.popleft()
        i = queue[0]
        least = value[i] + window - p[j]
        for other, extra in by_power.get(j, ()):
            if best[other] + extra < least:
                least, i = best[other] + extra, other
        best[j] = least = least + c[j]
        back[j] = i
        value[j] = worth = least + p[j]
        while queue and value[queue[-1]] >= worth:
            queue.pop()
        queue.append(j)
    cuts, j = [p[-1]], n - 1
    while j:
        j = back[j]
        cuts.append(p[j])
    return cuts[::-1]


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    window: int = 4096,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where its ids lie in which sequence.

    Documents are range partitioned and sorted by id, tokenised where they arrive, and cut
    in blocks of about BLOCK tokens; the last sequence of a block is the only one whose
    end is given, so padding does not grow with the data. Sequence ids hold the partition
    above bit 33 and count up inside it. with_ids adds the piece's ids (array<int>).

    NULL or empty text still has the end id. Rows that repeat an id are documents of their
    own, next to each other in order of their texts; NULL ids come first. An empty table
    gives no rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_file)
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows, n = pack_block(held, tokens.stops, window, sequence)
            sequence += n
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            if with_ids:
                columns.append(pa.array([r[7].astype("i4") for r in rows], pa.list_(pa.int32())))
                names = [*names, "ids"]
            yield pa.record_batch(columns, names=names)

        for docs_, texts in together(batches):
            flat, edges = tokens.encode(texts)
            for doc, low, high in zip(docs_, edges.tolist(), edges[1:].tolist()):
                ids = np.empty(high - low + 1, "u4")
                ids[:-1], ids[-1] = flat[low:high], end_id
                held.append((doc, ids))
                size += len(ids)
                if size >= BLOCK:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    sorted_rows = rows.repartitionByRange("doc_id").sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))


def pack_block(
    held: list[tuple[int | None, np.ndarray]], stops: np.ndarray, window: int, first: int
) -> tuple[list[tuple], int]:
    """Rows of the pieces of some documents, and the number of sequences they fill."""
    ends = np.cumsum([len(ids) for _, ids in held])
    flat = np.concatenate([ids for _, ids in held])
    cuts = best_cuts(*cut_places(flat, ends, stops), window)
    rows, doc, starts = [], 0, ends - [len(ids) for _, ids in held]
    starts, ends = starts.tolist(), ends.tolist()
    for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
        at = low
        while at < high:
            end = min(ends[doc], high)
            ids = flat[at:end]
            rows.append(
                (held[doc][0], at - starts[doc], end - at, zlib.crc32(ids.astype("<u4")),
                 ends[doc] - starts[doc], first + k, at - low, ids)
            )
            at = end
            if end == ends[doc]:
                doc += 1
    return rows, len(cuts) - 1
