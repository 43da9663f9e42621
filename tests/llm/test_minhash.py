import re
from itertools import combinations

import numpy as np
import pytest

from roomledger.llm import minhash
from roomledger.llm.components import components
from tests.llm.rows import awkward, none, texts, with_repeats


def shingles(text, size):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = {k: shingles(t, size) for k, t in rows.items()}
    label = {k: k for k in rows}
    links = [
        (a, b) for a, b in combinations(rows, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {k: (len(sets[k]), label[k], label[k] == k) for k in rows}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    found = minhash.near_duplicates(awkward(spark), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(
        dict(enumerate(texts())), size, percent
    )


def test_chains_through_one_bucket(spark, monkeypatch):
    """Copies each a few words further from the first: linked to neighbours only."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    words = [f"w{k}" for k in range(400)]
    rows = {}
    for k in range(40):
        own = words.copy()
        for j in range(6 * k, 6 * k + 60):
            own[j] = f"new{j}"
        rows[39 - k if k % 2 else k] = " ".join(own)
    docs = spark.createDataFrame([(k, t) for k, t in rows.items()], "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert found == brute(rows, 3, 85)


def test_repeats_nulls_and_empty(spark):
    docs = with_repeats(spark)
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    left = minhash.drop_near_duplicates(docs)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == docs.columns and len(set(ids) - {None}) == len(ids) - 2
    assert set(ids) - {None} == {r.doc_id for r in rows if r.kept} - {None}
    assert minhash.near_duplicates(none(spark)).count() == 0
    assert minhash.drop_near_duplicates(none(spark)).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.node: r.component for r in found} == {k: 0 for k in range(61)} | {100: 100, 101: 100}
    assert len(found) == 63
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_bands_miss_a_pair_once_in_a_million():
    for s in (0.8, 0.85, 0.9):
        assert (1 - s**minhash.ROWS) ** minhash.bands_for(s) <= 1e-6


def test_odd_sketches_differ_in_no_more_than_the_sets_do():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 6000, dtype="u8") * np.uint64(2)
    for size in (1, 30, 3000):
        for _ in range(50):
            a, b = (np.unique(rng.choice(pool, size)) for _ in range(2))
            x, y = (np.frombuffer(minhash.odd_sketch(s), "u1") for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    assert len(minhash.odd_sketch(pool[:0])) * 8 == minhash.ODD_BITS


def test_an_id_with_two_texts_has_the_links_of_both(spark):
    def text(name, changed=0):
        return " ".join(f"{name}{k}" if k >= changed else f"other{name}{k}" for k in range(200))

    stayed = set()
    for order in (1, -1):
        rows = [(7, text("a")), (7, text("b")), (8, text("a", 3)), (9, text("b", 3)), (10, text("c"))][::order]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        found = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()}
        assert found == {(7, 7), (8, 7), (9, 7), (10, 10)}
        left = {r.doc_id: r.text for r in minhash.drop_near_duplicates(docs).collect()}
        assert set(left) == {7, 10}
        stayed.add(left[7])
    assert len(stayed) == 1
