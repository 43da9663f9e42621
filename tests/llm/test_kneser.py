import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from roomledger.llm import kneser
from tests.llm.rows import awkward, none, texts, with_repeats

LABELS = "doc_id bigint, quality int, toxic int"


def brute_bits(train, tests):
    """Modified Kneser-Ney by its definition, one text at a time."""
    def grams(text):
        return [int(g) for part in kneser.grams_of(text) for g in part]

    counts = {kneser.ORDER: Counter(g for t in train for g in grams(t))}
    for n in range(kneser.ORDER - 1, 0, -1):
        counts[n] = Counter(g % (kneser.SYMBOLS**n) for g in counts[n + 1])

    def discounts(n):
        t = [sum(c == k for c in counts[n].values()) for k in range(5)]
        y = t[1] / max(t[1] + 2 * t[2], 1)
        return [0] + [max(0.01, min(k - 0.01, k - (k + 1) * y * t[k + 1] / max(t[k], 1))) for k in (1, 2, 3)]

    off = {n: discounts(n) for n in counts}
    contexts = {n: defaultdict(list) for n in counts}
    for n in counts:
        for g, c in counts[n].items():
            contexts[n][g // kneser.SYMBOLS].append(c)

    def p(g, n):
        if n == 0:
            return 1 / kneser.SYMBOLS
        below = p(g % kneser.SYMBOLS ** (n - 1), n - 1)
        own = contexts[n].get(g // kneser.SYMBOLS)
        if not own:
            return below
        c = counts[n].get(g, 0)
        rest = sum(off[n][min(x, 3)] for x in own)
        return (max(c - off[n][min(c, 3)], 0) + rest * below) / sum(own)

    return [sum(-math.log2(p(g, kneser.ORDER)) for g in grams(t)) for t in tests]


def test_bits_equal_the_definition(spark):
    own = {k: t for k, t in enumerate(texts()) if t}
    trusted = [k for k in own if k % 2 == 0]
    docs = awkward(spark).selectExpr("doc_id", "text", "'en' as lang")
    labels = spark.createDataFrame([(k, 1, 0) for k in trusted] + [(None, 1, 0), (1, 0, 0)], LABELS)
    found = {r.doc_id: r for r in kneser.perplexities(docs, labels).collect()}
    assert len(found) == len(texts())
    for k, bits in zip(own, brute_bits([own[k] for k in trusted], own.values())):
        assert found[k].bits_per_symbol * found[k].symbols == pytest.approx(bits)
        assert found[k].perplexity == pytest.approx(2 ** (bits / len(own[k])))
    assert found[0].kept and found[0].perplexity is None


def test_unseen_bits_threshold_and_kept_equal_the_definition(spark):
    rng = np.random.default_rng(3)
    parts = ["stone", "river", "light", "over", "under", "the", "and", "walk", "near"]
    rows = [(k, " ".join(rng.choice(parts, int(rng.integers(1, 30)))), "aa") for k in range(60)]
    rows += [(100 + k, "".join(rng.choice(list("xyzqw "), 40)), "aa") for k in range(6)] + [(200, "", "aa"), (None, "qqqq qqq", "aa")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    found = {r.doc_id: r for r in kneser.perplexities(docs, labels).collect()}
    halves = {r.doc_id: r.half for r in docs.selectExpr("doc_id", "1 + pmod(xxhash64(text), 2) as half").collect()}
    texts_ = {k: t for k, t, _ in rows}
    unseen = {}
    for half in (1, 2):
        train = [texts_[k] for k in range(40) if halves[k] == 3 - half]
        own = [k for k in texts_ if halves[k] == half and texts_[k]]
        unseen |= dict(zip(own, brute_bits(train, [texts_[k] for k in own])))
    each = sorted(unseen[k] / len(texts_[k]) for k in range(40))
    threshold = each[min(math.ceil(kneser.QUANTILE * 40), 40) - 1]
    usual = each[math.ceil(0.5 * 40) - 1]
    for k, r in found.items():
        assert r.threshold == pytest.approx(threshold)
        if not texts_[k]:
            assert r.kept and r.unseen_bits is None
            continue
        assert r.unseen_bits == pytest.approx(unseen[k] / len(texts_[k]))
        judged = (unseen[k] + kneser.PRIOR * usual) / (len(texts_[k]) + kneser.PRIOR)
        assert abs(judged - threshold) < 1e-9 or r.kept == (judged <= threshold)
    assert not all(r.kept for r in found.values())


def test_a_block_holds_its_grams_as_arrays():
    """8,192 grams come in batches, texts after them; a group is known from its neighbours by its key."""
    grams = np.concatenate(list(kneser.grams_of("abcabd" * 10)))
    distinct = np.unique(grams).view("i8")
    names = ["block", "lang", "half", "gram", "whole", "unseen", "doc_id", "text_hash", "text"]

    def batch(rows):
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def group(block):
        rows = [(block, "l", 1, int(g), 1.0 + block, 2.0, None, None, None) for g in distinct[::-1]]
        return rows + [(block, "l", 1, None, None, None, 7, 8, "abcabd" * 10), (block, "l", 1, None, None, None, 9, 8, "")]

    rows = group(0) + group(1)
    for size in (1, 3, len(rows)):
        cut = [batch(rows[k : k + size]) for k in range(0, len(rows), size)]
        out = [r for b in kneser._scored(iter(cut)) for r in b.to_pylist()]
        assert [(r["doc_id"], r["symbols"], r["bits"], r["unseen"]) for r in out] == [
            (7, 60, 60.0, 120.0), (9, 0, 0.0, 0.0), (7, 60, 120.0, 120.0), (9, 0, 0.0, 0.0)
        ]


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = "".join(chr(c) for c in np.random.default_rng(2).integers(1, 3000, 500))
    whole = np.concatenate(list(kneser.grams_of(text)))
    monkeypatch.setattr(kneser, "PIECE", 7)
    assert np.concatenate(list(kneser.grams_of(text))).tolist() == whole.tolist() and len(whole) == 500
    monkeypatch.setattr(kneser, "HELD", 16)
    tally = kneser.Tally()
    for part in np.array_split(np.tile(whole, 3), 20):
        tally.add((1, "x"), part)
    grams, counts = tally.merge((1, "x"))
    assert dict(zip(grams.tolist(), counts.tolist())) == {g: 3 * c for g, c in Counter(whole.tolist()).items()}


def test_rejects_junk_and_keeps_clean_text(spark):
    rng = np.random.default_rng(4)
    parts = ["stone", "river", "light", "over", "under", "the", "and", "walk", "near"]
    clean = [" ".join(rng.choice(parts, 60)) for _ in range(120)]
    junk = ["".join(chr(c) for c in rng.integers(33, 127, 300)) for _ in range(10)]
    docs = spark.createDataFrame([(k, t, "xx") for k, t in enumerate(clean + junk)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)], LABELS)
    assert {r.doc_id for r in kneser.drop_unlike_trusted(docs, labels).collect()} == set(range(120))


def test_repeats_nulls_and_empty(spark):
    docs = with_repeats(spark)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    assert kneser.perplexities(docs, labels).count() == docs.count()
    left = kneser.drop_unlike_trusted(docs, labels)
    assert left.columns == docs.columns
    no_labels = spark.createDataFrame([], LABELS)
    assert kneser.drop_unlike_trusted(docs, no_labels).count() == docs.count()
    assert kneser.perplexities(none(spark), labels).count() == 0


def test_no_text_is_judged_by_a_model_that_has_seen_it(spark):
    rng = np.random.default_rng(6)
    parts = ["stone", "river", "light", "over", "under", "the", "and", "walk", "near"]
    clean = [" ".join(rng.choice(parts, 60)) for _ in range(300)]
    noise = ["".join(rng.choice(list("abcdefghijklm"), 4)) for _ in range(10)]
    mixed = [" ".join([*rng.choice(parts, 59), noise[k]]) for k in range(10)]
    odd = "".join(chr(c) for c in rng.integers(33, 127, 2000))
    docs = spark.createDataFrame(
        [(k, t, "xx") for k, t in enumerate([*clean, odd, *mixed])], "doc_id bigint, text string, lang string"
    )
    labels = spark.createDataFrame([(k, 1, 0) for k in range(301)], LABELS)
    found = {r.doc_id: r for r in kneser.perplexities(docs, labels).collect()}
    assert not found[300].kept and found[300].unseen_bits > 1.3 * found[300].bits_per_symbol
    for k in range(301, 311):  # a little above usual text is enough
        assert found[k].threshold < found[k].unseen_bits < 1.5 * found[k].threshold and not found[k].kept
    lost = [k for k in range(300) if not found[k].kept]
    assert len(lost) <= 3


def test_junk_in_other_scripts_and_all_trusted_train(spark, monkeypatch):
    rng = np.random.default_rng(9)
    scripts = {
        "ru": "камень река свет над под и гулять рядом снова", "el": "πέτρα ποτάμι φως πάνω κάτω και κοντά ξανά",
        "ja": "石は 川の 光が 上に 下で そして 歩く 近い 再び", "ar": "حجر نهر ضوء فوق تحت و يمشي قرب",
    }
    rows, junk = [], []
    for lang, words in scripts.items():
        parts, letters = words.split(), sorted(set(words))
        rows += [(len(rows) + k, " ".join(rng.choice(parts, 60)), lang) for k in range(120)]
        for _ in range(10):
            junk.append(len(rows))
            rows.append((junk[-1], "".join(rng.choice(letters, 300)), lang))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k, _, _ in rows if k not in junk], LABELS)
    found = {r.doc_id: r for r in kneser.perplexities(docs, labels).collect()}
    assert not any(found[k].kept for k in junk)
    assert sum(not r.kept for r in found.values()) <= len(junk) + 8
    # Letters of a script are not told apart by remainder: the other script's text is no usual text.
    assert len(set(np.concatenate(list(kneser.grams_of("".join(map(chr, range(1, 3000)))))).tolist())) == 2999
    monkeypatch.setattr(kneser, "MOST_WORDS", 0)  # trusted ids by shuffle, negative ids too
    few = docs.selectExpr("doc_id - 100 as doc_id", "text", "lang")
    again = kneser.perplexities(few, labels.selectExpr("doc_id - 100 as doc_id", "quality", "toxic"))
    for r in again.collect():
        assert r.bits_per_symbol == pytest.approx(found[r.doc_id + 100].bits_per_symbol)


def test_common_grams_are_broadcast_and_others_asked_for(spark, monkeypatch):
    """Blocks of one id, long texts' own blocks, no common grams or many: the bits are the same."""
    rng = np.random.default_rng(12)
    parts = ["stone", "river", "light", "over", "under", "the", "and", "walk", "near"]
    rows = [(k, " ".join(rng.choice(parts, int(rng.integers(1, 60)))), "aa" if k % 3 else None) for k in range(40)]
    rows += [(50, "long text " * 2000, "aa"), (None, "no id", "aa"), (51, "", "bb"), (51, None, "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(30)], LABELS)

    def found():
        return sorted(
            (r.text_hash, r.doc_id or -1, r.symbols, round(r.bits_per_symbol or 0, 9), round(r.unseen_bits or 0, 9), r.kept)
            for r in kneser.perplexities(docs, labels).collect()
        )

    usual = found()
    assert len(usual) == len(rows)
    monkeypatch.setattr(kneser, "BLOCK_IDS", 4)
    monkeypatch.setattr(kneser, "COMMON", 0)
    assert found() == usual
    monkeypatch.setattr(kneser, "COMMON", 20)
    monkeypatch.setattr(kneser, "PACKED", 100)
    assert found() == usual


def test_packs_hold_every_text():
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    rows = [(k // 5, "l", 1 + k % 2, k, -k, "abcabd" * k) for k in range(20)]
    names = ["block", "lang", "half", "doc_id", "text_hash", "text"]
    packs = list(kneser._packed([pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)]))
    assert len(packs) == 8  # a block's halves
    found = []
    for pack in packs:
        key = [pack.column(c)[0].as_py() for c in ("block", "lang", "half")]
        with pa.ipc.open_stream(pack.column("texts")[0].as_buffer()) as texts:
            found += [(*key, *r.values()) for b in texts for r in b.to_pylist()]
    assert sorted(found) == sorted(rows)


def test_a_tally_lets_go_when_it_is_full(monkeypatch):
    monkeypatch.setattr(kneser, "HELD", 64)
    monkeypatch.setattr(kneser, "PIECE", 32)
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in range(0x4E00, 0x5E00)]
    rows = [(k // 10, "l", 1, "".join(rng.choice(letters, 50)), k % 2 == 0) for k in range(30)]
    names = ["block", "lang", "half", "text", "trusted"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_()]
    out = list(kneser._gathered(iter([pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)])))
    assert max(len(b) for b in out) < 10 * 50
    found = Counter()
    for r in (r for b in out for r in b.to_pylist()):
        found[r["block"], r["half"], r["gram"]] += r["n"]
    slow = Counter()
    for block, _, half, text, trusted in rows:
        for gram in np.concatenate(list(kneser.grams_of(text))).view("i8").tolist():
            slow[block, 0, gram] += 1
            if trusted:
                slow[None, half, gram] += 1
    assert found == slow


def test_common_grams_take_no_object_per_row():
    import tracemalloc

    import pyarrow as pa

    n = 100_000
    values = {c: pa.array(np.arange(n, dtype=t)) for c, t in (("gram", "i8"), ("bits0", "f8"), ("bits1", "f8"), ("bits2", "f8"))}
    table = pa.table({"lang": pa.array(["de", "en"] * (n // 2)), **values})
    tracemalloc.start()
    found = kneser._by_lang(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * n
    assert set(found) == {"de", "en"} and found["en"][0][:2].tolist() == [1, 3]
    assert kneser._by_lang(table.slice(0, 0)) == {}
