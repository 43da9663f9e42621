import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from roomledger.llm import fmindex, passages, repeats
from tests.llm.rows import awkward, none, texts, with_repeats


def brute(rows, window, byte):
    """(removed, spans, sha) per id; symbols are bytes or words, judged window by window."""
    split = {
        k: list((t or "").encode()) if byte else re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        for k, t in rows.items()
    }
    first, out = {}, {}
    for k in sorted(rows):
        own = split[k]
        gone = [False] * len(own)
        for s in range(len(own) - window + 1):
            w = bytes(own[s : s + window]) if byte else tuple(own[s : s + window])
            if w in first and (byte or first[w] < k):
                gone[s : s + window] = [True] * window
            first.setdefault(w, k)
        left = [x for x, g in zip(own, gone) if not g]
        raw = bytes(left) if byte else b" ".join(left)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(own), sum(gone), runs, hashlib.sha256(raw).hexdigest())
    return out


def shared(seed):
    """Texts that share passages with small changes, in other orders and overlapping."""
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("a", "en", "ißt", "o")]
    base = [list(rng.choice(words, 120)) for _ in range(4)]
    out = {}
    for k in range(40):
        own = []
        for _ in range(int(rng.integers(1, 4))):
            part = list(base[rng.integers(4)])
            low = int(rng.integers(0, 80))
            part = part[low : low + int(rng.integers(5, 100))]
            if part and rng.random() < 0.5:
                part[rng.integers(len(part))] = f"new{k}"
            own += part + list(rng.choice(words, int(rng.integers(0, 10))))
        out[int(k * 7 % 41)] = (" " if k % 5 else "\n").join(own) + ("  " if k % 3 else "")
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [1 << 21, 2000])
def test_shared_passages(spark, monkeypatch, seed, size):
    monkeypatch.setattr(passages, "INDEX_BYTES", size)
    rows = shared(seed)
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.n_removed, r.n_spans, r.kept_sha256) for r in fmindex.without_shared_passages(docs).collect()}
    assert found == brute(rows, 13, byte=False)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(docs).collect()}
    assert found == brute(rows, 100, byte=True)


def test_awkward_texts(spark, monkeypatch):
    monkeypatch.setattr(passages, "PIECE", 1000)
    rows = dict(enumerate(texts()))
    docs = awkward(spark)
    found = {r.doc_id: (r.n_words, r.n_removed, r.n_spans, r.kept_sha256) for r in fmindex.without_shared_passages(docs).collect()}
    assert found == brute(rows, 13, byte=False)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(docs).collect()}
    assert found == brute(rows, 100, byte=True)


def test_repeats_nulls_and_empty(spark):
    docs = with_repeats(spark)
    for operator in (fmindex.without_shared_passages, repeats.without_repeats):
        rows = operator(docs).collect()
        assert len(rows) == docs.count() and sum(r.doc_id is None for r in rows) == 2
        assert operator(none(spark)).count() == 0
    assert repeats.repeat_groups(none(spark)).count() == 0


def brute_repeats(strings, least):
    """Maximal repeats by their definition."""
    places = defaultdict(set)
    for k, s in enumerate(strings):
        for i in range(len(s)):
            for j in range(i + least, len(s) + 1):
                places[s[i:j]].add((k, i))
    out = set()
    for text, where in places.items():
        if len(where) < 2:
            continue
        left = {strings[k][i - 1] if i else -1 - 1000 * k for k, i in where}
        right = {strings[k][i + len(text)] if i + len(text) < len(strings[k]) else -1 - k - 1000 * i for k, i in where}
        if len(left) > 1 and len(right) > 1:
            out.add((len(text), frozenset(where)))
    return out


def test_interval_tree_gives_all_maximal_repeats():
    rng = np.random.default_rng(6)
    for n in range(60):
        strings = [bytes(rng.choice(list(b"ab"), int(rng.integers(1, 30)))) for _ in range(int(rng.integers(1, 6)))]
        array = repeats.SuffixArray(strings, 3)
        found = {
            (length, frozenset((int(array.owner[w]), int(w - array.starts[array.owner[w]])) for w in where))
            for length, where in repeats.maximal_repeats(array, 3)
        }
        assert found == brute_repeats(strings, 3)


def test_groups_hold_all_occurrences(spark):
    rows = shared(3)
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    groups = defaultdict(set)
    for r in repeats.repeat_groups(docs, 60).collect():
        text = rows[r.doc_id].encode()[r.start : r.start + r.length]
        groups[r.group, r.length, text].add((r.doc_id, r.start))
    assert groups and len({g for g, _, _ in groups}) == len(groups)
    for (_, _, text), where in groups.items():
        assert len(where) > 1
    raw = {k: t.encode() for k, t in rows.items()}
    covered = {(d, i) for (_, n, _), where in groups.items() for d, s in where for i in range(s, s + n)}
    seen = defaultdict(list)
    for k, t in raw.items():
        for s in range(len(t) - 59):
            seen[t[s : s + 60]].append((k, s))
    wanted = {(k, i) for where in seen.values() if len(where) > 1 for k, s in where for i in range(s, s + 60)}
    assert covered == wanted


def test_matching_statistics_and_wavelet():
    rng = np.random.default_rng(7)
    for _ in range(40):
        texts_ = [rng.integers(1, 6, int(rng.integers(1, 40))) for _ in range(4)]
        depth = int(rng.integers(1, 9))
        index = fmindex.FMIndex(texts_, depth)
        queries = [rng.integers(1, 9, int(rng.integers(0, 30))) for _ in range(5)]
        length, low, high = fmindex.matching_statistics(index, queries)
        at = 0
        for query in queries:
            for i in range(len(query)):
                best = max(
                    (d for d in range(1, min(depth, len(query) - i) + 1)
                     if any((t[j : j + d] == query[i : i + d]).all() for t in texts_ for j in range(len(t) - d + 1))),
                    default=0,
                )
                assert length[at] == best
                if best:
                    times = sum((t[j : j + best] == query[i : i + best]).all() for t in texts_ for j in range(len(t) - best + 1))
                    assert high[at] - low[at] == times
                at += 1
    symbols = rng.integers(0, 37, 500)
    matrix = fmindex.WaveletMatrix(symbols)
    ends, which = rng.integers(0, 501, 300), rng.integers(0, 37, 300)
    assert matrix.rank(which, ends).tolist() == [(symbols[:e] == s).sum() for s, e in zip(which, ends)]


def test_groups_name_copies_and_long_repeats_whole(spark):
    rng = np.random.default_rng(12)

    def noise(n):
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n))

    long, alone, short = noise(5000), noise(300), noise(40)
    one, other = noise(200) + long + noise(150), noise(90) + long + noise(300)
    texts_ = {1: one, 2: other, 3: one, 4: one, 5: alone, 6: alone, 7: noise(400), 8: short, 9: short}
    docs = spark.createDataFrame(list(texts_.items()), "doc_id bigint, text string")
    groups = defaultdict(set)
    for r in repeats.repeat_groups(docs, 100).collect():
        groups[r.group, r.length].add((r.doc_id, r.start))
    places = {texts_[min(p)[0]][min(p)[1] :][:n]: p for (_, n), p in groups.items()}
    left = len(long)
    assert len(groups) == len(places) == 3
    assert places[alone] == {(5, 0), (6, 0)} and places[one] == {(1, 0), (3, 0), (4, 0)}
    (repeat,) = set(places) - {alone, one}
    assert long in repeat and left <= len(repeat) < left + 5
    assert {d for d, _ in places[repeat]} == {1, 2, 3, 4}
    assert all(texts_[d][s : s + len(repeat)] == repeat for d, s in places[repeat])
