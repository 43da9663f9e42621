import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from roomledger.llm import bpe
from tests.llm.rows import awkward, none, texts, with_repeats

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(spark):
    enc = reference()
    found = {r.doc_id: r for r in bpe.round_trip(awkward(spark), FILE, public_tokenizers.PATTERN).collect()}
    assert len(found) == len(texts())
    for k, t in enumerate(texts()):
        ids = enc.encode_ordinary(t or "")
        assert found[k].n_tokens == len(ids)
        assert found[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encoded_ids_decode(spark):
    docs = with_repeats(spark)
    ids = bpe.encode_documents(docs, FILE, public_tokenizers.PATTERN)
    raw = bpe.decode_documents(ids, FILE, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in raw) == sorted(r.text or "" for r in docs.collect())


def test_long_texts_are_cut_at_safe_places():
    enc = reference()
    pieces = ["don't  stop", "   ", "\n\n x", "abc 123 !!", " \t y", "é ü ", "\x1c z ", "a" * 30]
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = "".join(pieces[k] for k in rng.integers(0, len(pieces), 40))
        parts = list(bpe.safe_parts(text, 37))
        assert "".join(parts) == text
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)
    assert len(list(bpe.safe_parts("some words " * 100, 50))) > 10


def test_empty_table(spark):
    assert bpe.round_trip(none(spark), FILE, public_tokenizers.PATTERN).count() == 0
