import hashlib
import math

import numpy as np
import pytest

from roomledger.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, distance string, vector string"


def brute(rows, k, rounds, dims):
    """(vec_id, cluster, distance) of every kept vector, in any order, and the centroids."""
    kept = []
    for id_, values in rows:
        if values is None or len(values) != dims:
            continue
        if any(x is None or not math.isfinite(x) for x in values):
            continue
        bound = 2**27
        kept.append((id_, [max(-bound, min(bound, math.floor(256 * float(np.float32(x))))) for x in values]))
    name = lambda id_: hashlib.sha256(f"2:{'' if id_ is None else id_}".encode()).hexdigest()
    now = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(now))

    for _ in range(rounds):
        groups = [[] for _ in now]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        now = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, now)]
    return [(id_, *reversed(nearest(v))) for id_, v in kept], now


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], SCHEMA)


def key(row):
    return tuple(str(x) for x in row)


def odd_rows(dims):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(0, 0.2, dims).round(1).tolist()) for k in range(60)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[3][1])]
    rows += [(100 + k, rows[5][1]) for k in range(30)]  # one vector many times
    rows += [(200, None), (201, []), (202, [0.5] * (dims - 1)), (203, [0.5] * (dims + 1))]
    rows += [(204, [float("nan")] * dims), (205, [None, *[0.1] * (dims - 1)]), (206, [float("inf"), *[0.0] * (dims - 1)])]
    return rows + [(207, [3e38] * dims), (208, [-3e38] * dims), (209, [-0.001] * dims)]


@pytest.mark.parametrize("dims, k, rounds", [(4, 10, 5), (64, 40, 2), (1, 3, 3), (4, 500, 1)])
def test_equals_brute_force(spark, dims, k, rounds):
    rows = odd_rows(dims)
    wanted, last = brute(rows, k, rounds, dims)
    clusters, found = centroids.centroid_clusters(rows_of(spark, rows), k=k, rounds=rounds, dims=dims)
    assert found == last
    assert sorted(map(tuple, clusters.collect()), key=key) == sorted(wanted, key=key)


def test_sums_and_digests(spark):
    rows = odd_rows(4)[:90]
    wanted, last = brute(rows, 6, 2, 4)
    found = centroids.inertias(rows_of(spark, rows), k=6, rounds=2, dims=4).collect()
    assert len(found) == len(wanted)
    for r in found:
        assert r.cluster_inertia == sum(d for _, c, d in wanted if c == r.cluster)
        assert r.inertia == sum(d for *_, d in wanted)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, last[r.cluster])).encode()).hexdigest()


def test_lists_stop_early_and_take_the_smaller_of_ties():
    rng = np.random.default_rng(1)
    for dims, k, spread in [(2, 300, 1000), (3, 40, 4), (8, 7, 2), (64, 40, 50)]:
        points = rng.integers(-spread, spread, (500, dims))
        lists = centroids.SortedLists(rng.integers(-spread, spread, (k, dims)).tolist())
        all_ = ((points[:, None, :] - lists.centroids[None]) ** 2).sum(axis=2)
        found, best, computed = lists.nearest(points)
        assert (found == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
        assert computed <= all_.size
        if dims == 2:
            assert computed < 0.2 * all_.size


def test_nothing_to_cluster(spark):
    clusters, found = centroids.centroid_clusters(rows_of(spark, []))
    assert (clusters.count(), found) == (0, [])
    assert centroids.inertias(rows_of(spark, [(1, None), (2, [1.0])])).count() == 0
