"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Longer texts are cut at safe places into parts of about this many characters.
PART = 1 << 20

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 token, rank per line), once per Python worker."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def safe_parts(text: str, size: int = PART) -> Iterator[str]:
    """Cut a text where no match of the pre-splitting pattern can span.

    A match that holds a space has it first, or is white space alone. So the place between
    a character that is no white space and a following single space, itself followed by no
    white space, always lies between two matches. Where no such place follows, the
    part grows until one does.
    """
    start = 0
    while len(text) - start > size:
        cut = start + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of one text as unsigned 32-bit integers."""
    parts = [enc.encode_ordinary(part) for part in safe_parts(text)]
    return np.concatenate([np.asarray(p, "<u4") for p in parts]) if parts else np.zeros(0, "<u4")


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of docs: doc_id and ids, an array of token ids.

    NULL text counts as empty, which has no ids. A NULL id stays NULL; repeated rows are
    encoded each. Other columns are not read. Every match of the pattern is merged by
    itself; special tokens do not exist.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode(enc, t or "") for t in part.column(1).to_pylist()]
                flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype("i4")
                ends = np.cumsum([0, *map(len, ids)]).astype("i4")
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.record_batch([part.column(0), lists], names=["doc_id", "ids"])

    return _columns(docs, id_column, text_column).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(
    encoded: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id"
) -> DataFrame:
    """The bytes behind each row's ids: doc_id, decoded (binary). NULL ids: no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "decoded"]
            )

    rows = encoded.select(F.col(id_column).cast("bigint").alias("doc_id"), "ids")
    return rows.mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode and decode each text where it lies: digests of the ids and of the decoded bytes.

    The same rules for NULL, empty, long and repeated rows as encode_documents. Ids do not
    leave the task, since only their digest is asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                n, size, of_ids, of_bytes = 0, 0, hashlib.sha256(), hashlib.sha256()
                for part in safe_parts(text or ""):
                    ids = enc.encode_ordinary(part)
                    raw = enc.decode_bytes(ids)
                    of_ids.update(np.asarray(ids, "<u4"))
                    of_bytes.update(raw)
                    n, size = n + len(ids), size + len(raw)
                rows.append((n, of_ids.hexdigest(), of_bytes.hexdigest(), size))
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
            )

    return _columns(docs, id_column, text_column).mapInArrow(run, SCHEMA)


def _columns(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
