"""Hashes over the bytes and words of many texts at once, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Characters of text that are worked on at once.
TOGETHER = 1 << 21

# White space that parts words: space, and tab to carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 sequence at the given places: well-mixed 64-bit numbers."""
    return mixed(x.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit sums so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A random number for each byte; white space counts nothing.
BYTE = splitmix(np.arange(1000, 1256, dtype="u8"))
BYTE[_SPACE] = 0
_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32
LOWER_BYTE = BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes hashed at once.
PIECE = 1 << 20
# Words of more bytes are hashed one by one.
LONG_WORD = 256
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2^64, remembered for the next call."""
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, PIECE) + 1, base, "u8")
        found[0] = 1
        _POWERS[base] = found = np.cumprod(found)
    return found[:n]


@dataclass
class Words:
    """Words of some bytes: 64-bit hash, first byte and end byte of each."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words(data: np.ndarray, lower: bool) -> Words:
    """The runs of bytes that are not white space; lower folds A-Z before hashing.

    A word's hash is a polynomial in its bytes: the sum of byte number times power of the
    place, divided by the power of the first place. Equal words hash alike anywhere.
    """
    edge = np.diff((~_SPACE[data]).view("i1"), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), "u8")
    table = LOWER_BYTE if lower else BYTE
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(int(np.searchsorted(ends, first + PIECE, side="right")), at + 1)
        size = int(ends[to - 1] - first)
        terms = table[data[first : first + size]]
        terms *= powers(_BASE, size)
        local = starts[at:to] - first
        sums = np.add.reduceat(terms, local)
        sums *= powers(_INVERSE, size)[local]
        hashes[at:to] = sums
        at = to
    # Long words with regular parts can agree in such a sum: they have a digest of their bytes.
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        own = data[starts[k] : ends[k]]
        raw = (_LOWER[own] if lower else own).tobytes()
        hashes[k] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return Words(mixed(hashes + (ends - starts).astype("u8")), starts, ends)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one array of bytes, a space after each, and where each starts (and the end)."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.frombuffer(b" ".join([*texts, b""]), "u1"), starts


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive symbols, by the place of the first."""
    if len(hashes) < n:
        return np.zeros(0, "u8")
    last = len(hashes) - n + 1
    total = np.zeros(last, "u8")
    for k, power in enumerate(powers(_BASE, n)):
        total += hashes[k : k + last] * power
    return mixed(total)


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time, as many as make up TOGETHER characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(id_)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= TOGETHER:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
