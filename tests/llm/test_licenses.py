import re

import numpy as np

from roomledger.llm import licenses
from tests.llm.rows import awkward, none, with_repeats


def words(text):
    return re.findall(r"[a-z0-9]+", (text or "").lower())


def pairs(own):
    return list(zip(own, own[1:]))


def brute(rows):
    """Licenses whose shingles lie close together somewhere, at every place of every text."""
    out = set()
    for k, text in rows.items():
        own = pairs(words(text))
        for name, notice in licenses.NOTICES.items():
            wanted, n = set(pairs(words(notice))), len(words(notice))
            for start in range(0, max(len(own), 1), licenses.STEP):
                if not set(own[start : start + licenses.WINDOW - 1]) & wanted:
                    continue
                around = set(own[max(0, start - n) : start + n + licenses.WINDOW])
                if len(wanted & around) / len(wanted) >= licenses.CONTAINMENT:
                    out.add((k, name))
    return out


def corpus():
    rng = np.random.default_rng(11)
    parts = ["under", "the", "license", "stone", "river", "light", "work", "public", "version", "all"]
    rows = {}
    for k in range(300):
        own = list(rng.choice(parts, int(rng.integers(0, 60))))
        if k % 3:
            notice = list(licenses.NOTICES.values())[k % len(licenses.NOTICES)].split()
            if k % 5 == 0:
                notice = [w.upper() for w in notice]
            if k % 7 == 0 and len(notice) > 9:
                notice[4] = "changed"
            at = int(rng.integers(0, len(own) + 1))
            own[at:at] = notice
        rows[k] = ("\n" if k % 2 else "  ").join(own)
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    found = {(r.doc_id, r.license) for r in licenses.license_scan(docs).collect()}
    wanted = brute(rows)
    assert len(wanted) > 190 and found <= wanted
    assert len(found) >= 0.995 * len(wanted)


def test_runs_without_python(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.")], "doc_id bigint, text string")
    frame = licenses.license_scan(docs)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    (row,) = frame.collect()
    assert (row.doc_id, row.license, row.containment, row.word, row.windows) == (1, "All-Rights-Reserved", 1.0, 0, 1)


def test_awkward_rows(spark):
    assert licenses.license_scan(awkward(spark)).count() == 0
    docs = with_repeats(spark)
    twice = docs.selectExpr("doc_id", "concat(text, ' Released under the MIT License.') as text", "id", "kept")
    rows = licenses.license_scan(twice).collect()
    assert {r.license for r in rows} == {"MIT"}
    assert len(rows) == twice.filter("text is not null").select("doc_id", "text").distinct().count()
    assert licenses.license_scan(none(spark)).count() == 0
