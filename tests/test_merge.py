"""Keyed MERGE: what it changes, what it counts and which files it leaves alone."""

from pathlib import Path

import pytest

from roomledger.operators import merge
from roomledger.session import work_folder

SCHEMA = "id bigint, name string, size int"


@pytest.fixture
def folder(spark):
    return work_folder(spark, "test")


def load(spark, folder, *rows, schema=SCHEMA, **settings):
    load.n = getattr(load, "n", 0) + 1
    new = spark.createDataFrame(list(rows), schema)
    return merge.merge(new, f"{folder}/table", "id", f"{folder}/work{load.n}", **settings)


def stored(spark, folder):
    return {r.id: (r.name, r.size) for r in merge.read_merged(spark, f"{folder}/table").collect()}


def files(folder):
    return {str(f): f.stat().st_mtime_ns for f in Path(f"{folder}/table").rglob("part-*")}


def test_counts_and_rows(spark, folder):
    assert load(spark, folder, (1, "a", 1), (2, "b", None), (None, "c", 3)) == merge.Merged(3, 0, 0, 0)
    found = load(
        spark, folder,
        (1, "a", 1), (1, "a", 1),  # a copy of what is stored, twice
        (2, None, None),  # NULL for a value, and a value that moved: both are changes
        (None, "d", 3),
        (4, "x", 1), (4, "x", 2),  # two rows for a new key
        (5, "y", 1),
    )
    assert found == merge.Merged(inserted=1, updated=2, unchanged=1, refused=1)
    assert stored(spark, folder) == {1: ("a", 1), 2: (None, None), None: ("d", 3), 5: ("y", 1)}
    assert load(spark, folder, (1, "p", 1), (1, "q", 1)) == merge.Merged(0, 0, 0, 1)
    assert stored(spark, folder)[1] == ("a", 1)


def test_files_without_changes_are_untouched(spark, folder):
    load(spark, folder, *[(k, f"n{k}", k) for k in range(200)], buckets=8)
    before = files(folder)
    assert len({Path(f).parent for f in before}) == 8
    assert load(spark, folder, (7, "n7", 7)) == merge.Merged(0, 0, 1, 0)
    assert files(folder) == before
    assert load(spark, folder, (7, "new", 7), (8, "n8", 8)) == merge.Merged(0, 1, 1, 0)
    after = files(folder)
    gone = set(before) - set(after)
    assert len({Path(f).parent for f in gone}) == 1
    assert all(after[f] == before[f] for f in set(before) & set(after))
    rows = stored(spark, folder)
    assert len(rows) == 200 and rows[7] == ("new", 7) and rows[8] == ("n8", 8)


def test_a_table_keeps_its_number_of_partitions(spark, folder):
    load(spark, folder, *[(k, "n", k) for k in range(50)], buckets=4)
    load(spark, folder, *[(k, "m", k) for k in range(100)], buckets=32)
    assert len(stored(spark, folder)) == 100 == merge.read_merged(spark, f"{folder}/table").count()
    assert len({Path(f).parent for f in files(folder)}) == 4


def test_a_merge_cut_short_is_completed_by_the_next(spark, folder):
    load(spark, folder, *[(k, "n", k) for k in range(40)], buckets=4)
    before = {f: Path(f).read_bytes() for f in files(folder)}
    change = [(k, "changed", k) for k in range(40)]
    load(spark, folder, *change)
    # One partition as it was before, as if the rename of it had not come about.
    undone = sorted({Path(f).parent for f in before})[0]
    for file in undone.glob("*part-*"):
        file.unlink()
    for file, content in before.items():
        if Path(file).parent == undone:
            Path(file).write_bytes(content)
    found = load(spark, folder, *change)
    assert 0 < found.updated < 40 and found.updated + found.unchanged == 40
    assert set(stored(spark, folder).values()) == {("changed", k) for k in range(40)}


def test_nothing_to_merge_and_other_columns(spark, folder):
    assert load(spark, folder) == merge.Merged(0, 0, 0, 0)
    load(spark, folder, (1, "a", 1))
    assert load(spark, folder) == merge.Merged(0, 0, 0, 0)
    with pytest.raises(ValueError, match="columns"):
        load(spark, folder, (1, "a"), schema="id bigint, name string")
    assert load(spark, folder, (2, 1, "b"), schema="size int, id bigint, name string") == merge.Merged(0, 1, 0, 0)
    assert stored(spark, folder) == {1: ("b", 2)}


def test_a_hot_key_of_the_load_is_combined_before_the_shuffle(spark):
    new = spark.range(1000).selectExpr("if(id % 3 = 0, 5, id) as id", "'x' as name", "1 as size")
    plan = merge.one_per_key(new, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan
    (row,) = merge.one_per_key(new, "id").filter("_key = 5").collect()
    assert row._rows == 335 and row._agree
