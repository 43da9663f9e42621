import hashlib
import zlib
from collections import defaultdict

from roomledger.llm import merkle
from tests.llm.rows import awkward, none, with_repeats


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(row, lower=False):
    out = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is None:
            out.append("-")
            continue
        value = str(value)
        if lower and name == "text":
            value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)
        out.append(f"{len(value.encode())}:{value}")
    return sha("".join(out))


def tree(digests):
    """All levels of one tree, leaves first."""
    found = [digests]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([sha("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return found


def way(found, place):
    """(digests before, digests after) at each level of a tree, for one leaf."""
    for level in found[:-1]:
        start = place // 8 * 8
        yield level[start:place], level[place + 1 : start + 8]
        place //= 8


def expected(rows):
    """One tuple per row, in any order."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_digest(r)))
        trees[lang] = tree([row_digest(r) for r in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    for at, lang in enumerate(langs):
        for place, row in enumerate(groups[lang]):
            steps = [*way(trees[lang], place), *way(top, at)]
            id_ = row["doc_id"]
            hit = id_ is not None and zlib.crc32(str(id_).encode()) % 3 == 0
            digest = row_digest(row, lower=hit and row["text"] is not None)
            for before, after in steps:
                digest = sha("".join([*before, digest, *after]))
            proof = sha("".join("".join([*b, *a]) for b, a in steps))
            root = top[-1][0]
            yield id_, row_digest(row), trees[lang][-1][0], root, proof, digest, digest == root


def key(row):
    return tuple(str(x) for x in row)


def check(docs):
    found = merkle.tamper_check(docs).collect()
    assert sorted(map(tuple, found), key=key) == sorted(expected(docs.collect()), key=key)
    return found


def test_equals_brute_force_also_for_repeats_nulls_and_clashes(spark):
    found = check(awkward(spark))
    assert {r.verified for r in found} == {True, False}
    check(with_repeats(spark))


def test_many_leaves_in_one_group_are_several_blocks(spark):
    docs = spark.range(4700).selectExpr(
        "id * 3 as doc_id", "concat('Text ', id) as text",
        "if(id % 500 = 0, concat('l', id), if(id % 700 = 0, null, 'en')) as lang", "'s' as source", "id % 9 as n_chars",
    )
    found = check(docs)
    assert len({r.subroot for r in found}) > 8 and merkle.height(4700) > merkle.BAND


def test_copies_of_one_row_are_leaves_of_their_own(spark):
    check(spark.range(9).selectExpr("7L as doc_id", "'Same' as text", "'en' as lang", "'s' as source", "4L as n_chars"))


def test_lone_row_is_its_own_root(spark):
    docs = awkward(spark).filter("doc_id = 4")
    (row,) = check(docs)
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


def test_proofs_are_the_real_digests(spark):
    rows = merkle.manifest(awkward(spark)).collect()
    for row in rows:
        digest = row.leaf
        for level in filter(None, row.proof.split(",")):
            at, beside = int(level[0]) * 64, level[1:]
            digest = sha(beside[:at] + digest + beside[at:])
        assert digest == row.root


def test_empty_table(spark):
    assert merkle.tamper_check(none(spark)).count() == 0
