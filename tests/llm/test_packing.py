import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from roomledger.llm import packing
from tests.llm.rows import awkward, none, texts, with_repeats

FILE = public_tokenizers.path("word_bpe_49k.json")


def reference():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(spark):
    encode = reference()
    rows = packing.pack_documents(awkward(spark), FILE, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for k, t in enumerate(texts()):
        ids = encode(t) + [2]
        at = 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            own = np.array(ids[at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(own.tobytes()) and list(r.ids) == own.tolist()
            at += r.length
        assert at == len(ids)
    total = padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.05 * total


def test_cuts_are_the_best():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(2, 14))
        places = np.cumsum(np.append(0, rng.integers(1, 9, n)))
        cost = rng.integers(0, 6, n + 1)
        cost[0] = cost[-1] = 0
        window = 16

        def price(cuts):
            total = 0
            for a, b in zip(cuts, cuts[1:]):
                if places[b] - places[a] > window:
                    return 10**9
                size = int(places[b] - places[a])
                total += ((window - size) // 128 if size & (size - 1) == 0 else window - size) + cost[b]
            return total

        best = min(
            price([0, *[k for k in range(1, n) if mask >> (k - 1) & 1], n]) for mask in range(1 << (n - 1))
        )
        found = packing.best_cuts(places, cost, window)
        assert price([int(np.flatnonzero(places == c)[0]) for c in found]) == best


def test_memory_of_chunks_may_be_emptied(monkeypatch):
    encode = reference()
    tokens = packing.WordTokens(FILE)
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    for some in (["a b c.", "d!! e"], [f"word{k} w{k}, (x{k})" for k in range(60)], ["", "x́y Á 'S don't"]):
        ids, edges = tokens.encode(some)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [encode(t) for t in some]


def test_repeats_nulls_and_empty(spark):
    docs = with_repeats(spark)
    rows = packing.pack_documents(docs, FILE).collect()
    assert sum(r.start == 0 for r in rows) == docs.count()
    assert packing.pack_documents(none(spark), FILE).count() == 0
