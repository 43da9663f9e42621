"""Seeds with too many different contents for one index."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from roomledger.llm import fmindex, passages, repeats
from tests.llm.test_passages import brute, shared


def neighbours(n):
    """One passage in every third text, each time between other words; some neighbours repeat."""
    rng = np.random.default_rng(11)
    words = np.array([f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("", "n", "ß", "rt")])
    passage = list(rng.choice(words, 60))
    out = {}
    for k in range(n):
        own = list(rng.choice(words, int(rng.integers(0, 40))))
        if k % 3 == 0:
            own += passage + list(rng.choice(words[:3], int(rng.integers(0, 30))))
        if k % 50 == 0:
            own += passage[10:50]
        out[(k * 7) % n if n % 7 else k] = ("\t " if k % 4 else " ").join(own)
    return out


@pytest.mark.parametrize("size, rows", [(0, neighbours(400)), (3000, neighbours(400)), (0, shared(5))], ids=["all", "some", "shared"])
def test_hot_seeds_equal_brute_force(spark, monkeypatch, size, rows):
    monkeypatch.setattr(passages, "INDEX_BYTES", size)
    called, plain = [], passages._hot_spans
    monkeypatch.setattr(passages, "_hot_spans", lambda *a: called.append(1) or plain(*a))
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.n_removed, r.n_spans, r.kept_sha256) for r in fmindex.without_shared_passages(docs).collect()}
    assert found == brute(rows, 13, byte=False)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(docs).collect()}
    assert found == brute(rows, 100, byte=True)
    assert called


def test_two_texts_of_one_id(spark, monkeypatch):
    """Rows that repeat an id are no earlier documents to each other, also in a hot seed."""
    rows = neighbours(60)
    pairs = [(k // 2, text) for k, text in rows.items()]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    wanted = sorted(map(tuple, fmindex.without_shared_passages(docs).collect()))
    monkeypatch.setattr(passages, "INDEX_BYTES", 0)
    assert sorted(map(tuple, fmindex.without_shared_passages(docs).collect())) == wanted


def test_memory_of_a_hot_seed_is_bounded():
    """Ten times the contents of one seed take no more memory."""

    def peak(n):
        def batches():
            for at in range(0, n, 1000):
                rows = [(7, k, k, [0], 160, b"p" * 150 + b"%010d" % k) for k in range(at, at + 1000)]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
                yield passages._columns(rows, types, ["seed", "id", "cls", "starts", "size", "content"])

        tracemalloc.start()
        out = sum(b.num_rows for b in passages._indexed(repeats.later_occurrences(100), True)(batches()))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, top

    (few, low), (many, high) = peak(20_000), peak(200_000)
    assert (few, many) == (20_000, 200_000)
    assert high < 1.2 * low < 40 * passages.INDEX_BYTES
