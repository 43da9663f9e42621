"""Words that a sum of powers cannot tell apart."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from roomledger.llm import fmindex, minhash, packing, rolling


def pair(size):
    """Two words over two letters whose difference is a product of many even factors."""
    bits = [bin(k).count("1") % 2 for k in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_regular_words_differ():
    for size in (300, 1024, 2048, 4096):
        a, b = pair(size)
        data, _ = rolling.joined([a.encode(), b.encode(), a.upper().encode()])
        plain, folded = rolling.words(data, lower=False).hashes, rolling.words(data, lower=True).hashes
        assert len(set(plain.tolist())) == 3 and folded[0] == folded[2] != folded[1]
    sizes = [len(w) for w in ("x" * 256, "x" * 257)]
    assert sizes == [rolling.LONG_WORD, rolling.LONG_WORD + 1]


def test_operators_tell_them_apart(spark):
    a, b = pair(2048)
    common = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"{common} {a}"), (2, f"{common} {b}"), (3, b)], "doc_id bigint, text string")
    assert {r.doc_id: r.n_removed for r in fmindex.without_shared_passages(docs, window=13).collect()} == {1: 0, 2: 0, 3: 0}
    alone = spark.createDataFrame([(1, a), (2, b), (3, b)], "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(alone, shingle=3, percent=85).collect()}
    assert found == {1: 1, 2: 2, 3: 2}
    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(file)
    rows = packing.pack_documents(alone, file).filter("start = 0 and length = doc_tokens").collect()
    for r in rows:
        ids = [*tokenizer.encode(a if r.doc_id == 1 else b, add_special_tokens=False).ids, 2]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert len(rows) >= 2
