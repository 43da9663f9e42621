"""Passages of words shared with earlier documents, found by backward search in FM-indexes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from roomledger.llm.passages import Covered, Segment, Unit, without_covered
from roomledger.llm.rolling import words

# Words of a seed; fewer if the window is shorter.
SEED = 5


class WaveletMatrix:
    """A sequence of small integers, bit by bit, that counts a symbol in any prefix.

    Each level keeps one bit per symbol, packed in 64-bit words with running counts, and is
    sorted by that bit for the next level.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.n = len(symbols)
        self.bits = max(int(symbols.max(initial=0)).bit_length(), 1)
        self.levels = []
        now = symbols.astype("u4")
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> np.uint32(level)) & np.uint32(1)
            packed = np.packbits(bit.astype("u1"), bitorder="little")
            words_ = np.zeros((self.n >> 6) + 1, "u8")
            words_.view("u1")[: len(packed)] = packed
            counts = np.append(0, np.cumsum(np.bitwise_count(words_)))[:-1].astype("u4")
            zeros = int(self.n - bit.sum())
            self.levels.append((words_, counts, zeros))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros(len(ends), "i8"), ends.astype("i8")
        for depth, (words_, counts, zeros) in enumerate(self.levels):
            one = ((symbols >> (self.bits - 1 - depth)) & 1).astype(bool)
            low, high = (
                np.where(one, zeros + ones, at - ones)
                for at in (low, high)
                for ones in [self._ones(words_, counts, at)]
            )
        return high - low

    @staticmethod
    def _ones(words_: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, inner = at >> 6, (at & 63).astype("u8")
        mask = (np.uint64(1) << inner) - np.uint64(1)
        return counts[word].astype("i8") + np.bitwise_count(words_[word] & mask)


class FMIndex:
    """Texts of symbols >= 1, each followed by 0, sorted by their first `depth` symbols.

    Patterns up to that depth are found by backward search: the rows that start with them
    are an interval, and one step puts a symbol in front. A sort of that depth is enough for
    such patterns, since the rows of a pattern never depend on what comes after it.
    """

    def __init__(self, texts: list[np.ndarray], depth: int) -> None:
        flat = np.concatenate([part for text in texts for part in (text, [0])]).astype("i8")
        n = len(flat)
        self.depth, self.text = depth, flat
        self.owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
        ranks = {1: flat + 1}
        size = 1
        while size * 2 <= depth:
            ranks[size * 2] = self._pairs(ranks[size], ranks[size], size)
            size *= 2
        full = ranks[size] if size == depth else self._pairs(ranks[size], ranks[size], depth - size)
        self.rows = np.argsort(full, kind="stable")
        self.last = WaveletMatrix(flat[self.rows - 1])
        self.first = np.append(0, np.cumsum(np.bincount(flat)))
        # How far each row agrees with the one before: its longest common prefix up to depth.
        one, other = self.rows[:-1].copy(), self.rows[1:].copy()
        common = np.zeros(n, "i8")
        for level in [*sorted(ranks, reverse=True)] * 2:
            inside = (common[1:] + level <= depth) & (np.maximum(one, other) < n)
            at = np.minimum(one, n - 1), np.minimum(other, n - 1)
            same = inside & (ranks[level][at[0]] == ranks[level][at[1]])
            one, other = one + same * level, other + same * level
            common[1:] += same * level
        self.common = common

    @staticmethod
    def _pairs(one: np.ndarray, other: np.ndarray, step: int) -> np.ndarray:
        beyond = np.append(other[step:], np.zeros(min(step, len(other)), other.dtype))
        key = one.astype("u8") * np.uint64(int(other.max(initial=0)) + 2) + beyond.astype("u8")
        _, rank = np.unique(key, return_inverse=True)
        return rank.astype("i8") + 1

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with a symbol put in front."""
        base = self.first[symbols]
        return base + self.last.rank(symbols, low), base + self.last.rank(symbols, high)

    def parents(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the interval of rows that share its first `size` symbols."""
        new = self.common < size
        new[0] = True
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        return first[number], np.append(first[1:], len(new))[number]


def matching_statistics(index: FMIndex, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of the longest match, up to the index's depth, that starts at each place of the
    queries (joined), and the interval of rows where it is found.

    All queries are searched together, from their ends to the left: a step puts the next
    symbol in front of the match. If that is found nowhere, the match gives up its last
    symbols, one at a time, which widens its interval to that of all rows with the rest.
    """
    sizes = np.array(list(map(len, queries)), "i8")
    ends = np.cumsum(sizes)
    flat = np.concatenate([np.zeros(0, "i8"), *queries]).astype("i8")
    length = np.zeros(len(flat), "i8")
    low, high = np.zeros(len(flat), "i8"), np.zeros(len(flat), "i8")
    parents = [index.parents(d) for d in range(index.depth)]
    n = len(index.rows)
    own_low, own_high, own = np.zeros(len(sizes), "i8"), np.full(len(sizes), n), np.zeros(len(sizes), "i8")
    known = len(index.first) - 1
    for back in range(1, int(sizes.max(initial=0)) + 1):
        active = np.flatnonzero(sizes >= back)
        at = ends[active] - back
        symbols = flat[at]
        outside = (symbols <= 0) | (symbols >= known)
        full = own[active] == index.depth
        shrink = active[full]
        own_low[shrink], own_high[shrink] = (p[own_low[shrink]] for p in parents[index.depth - 1])
        own[shrink] -= 1
        todo = np.flatnonzero(~outside)
        while len(todo):
            who = active[todo]
            new_low, new_high = index.extend(symbols[todo], own_low[who], own_high[who])
            good = new_high > new_low
            hit = who[good]
            own_low[hit], own_high[hit] = new_low[good], new_high[good]
            own[hit] += 1
            todo, who = todo[~good], who[~good]
            empty = own[who] == 0
            todo, who = todo[~empty], who[~empty]
            own[who] -= 1
            for d in np.unique(own[who]).tolist():
                some = who[own[who] == d]
                own_low[some], own_high[some] = (p[own_low[some]] for p in parents[d])
        lost = active[outside]
        own_low[lost], own_high[lost], own[lost] = 0, n, 0
        length[at], low[at], high[at] = own[active], own_low[active], own_high[active]
    return length, low, high


def earlier_windows(window: int):
    """An index for passages: the windows that also start in a document with a smaller id.

    The segments are a shard: an FM-index is made of them, and each is streamed through it.
    """

    def index(segments: list[Segment]) -> Covered:
        hashes = [words(np.frombuffer(s.content, "u1"), lower=False).hashes for s in segments]
        _, symbols = np.unique(np.concatenate(hashes), return_inverse=True)
        ends = np.cumsum(list(map(len, hashes)))
        texts = np.split(symbols + 1, ends[:-1])
        made = FMIndex(texts, window)
        docs = np.array([s.doc for s in segments], "i8")
        length, low, _ = matching_statistics(made, texts)
        # The smallest document in each interval of rows that agree in a whole window.
        bounds = made.parents(window)[0]
        first = np.flatnonzero(np.append(True, bounds[1:] != bounds[:-1]))
        least = np.minimum.reduceat(docs[made.owner[made.rows]], first)
        of_row = np.searchsorted(first, low, side="right") - 1
        owner = np.repeat(np.arange(len(texts)), list(map(len, texts)))
        found = np.flatnonzero((length >= window) & (least[of_row] < docs[owner]))
        inner = found - (ends - list(map(len, texts)))[owner[found]]
        return list(zip(owner[found].tolist(), inner.tolist(), (inner + window).tolist()))

    return index


def without_shared_passages(
    docs: DataFrame, window: int = 13, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, n_spans, kept_sha256.

    A word goes if a window of consecutive words that covers it also starts in a document with
    a smaller id. Windows are judged on the input and never cross documents. NULL and blank
    texts have no words. A NULL id counts as the largest and stays NULL. Rows that repeat
    an id are no earlier documents to each other, and equal rows get equal results. An
    empty table gives no rows. Other columns are not read.
    """
    found = without_covered(
        docs, Unit("word", window, min(SEED, window)), earlier_windows(window), False, id_column, text_column
    )
    return found.withColumnRenamed("symbols", "n_words")
