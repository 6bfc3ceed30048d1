"""Near copies among vectors against all comparisons."""

import random

import numpy as np
import pytest

from tileframe.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, `row` string"


def plain(rows, threshold):
    """Each row with its links and component, all pairs compared."""
    good = {}
    for at, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[at] = np.asarray(v, dtype=np.float32).astype(float)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in good:
        for y in good:
            if x < y and rows[x][2] == rows[y][2] and len(good[x]) == len(good[y]):
                u, w = good[x] / abs(good[x]).max(), good[y] / abs(good[y]).max()
                if u @ w / np.sqrt(u @ u) / np.sqrt(w @ w) >= threshold:
                    links[x] += 1
                    links[y] += 1
                    parent[find(x)] = find(y)
    least = {}
    for x in good:
        least[find(x)] = min(least.get(find(x), 10**9), rows[x][0])
    out = [(r[0], links[x], least[find(x)] if x in good else r[0]) for x, r in enumerate(rows)]
    return sorted(((*r, r[0] is not None and r[0] == r[2]) for r in out), key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA).repartition(4)


EDGES = [
    (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [2.0, -0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 2), (5, None, 1), (6, [], 1),
    (7, [0.0, 0.0, 0.0], 1), (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 1.0, 0.0], 1), (10, [1.0, None, 0.0], 1),
    (11, [1.0, 0.0, 0.0], None), (2, [2.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [0.0, 3e38, 0.0], 1),
    (14, [0.0, 1e-38, 0.0], 1), (15, [5.0], 1), (16, [-5.0], 1),
]


def test_edges(spark):
    got = near_vectors.near_duplicates(made(spark, EDGES), tile=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(EDGES, 0.98)
    assert near_vectors.near_duplicates(made(spark, EDGES).where("false")).collect() == []
    assert near_vectors.near_duplicates(made(spark, EDGES[4:10])).where("n_links > 0 OR NOT kept").count() == 0


@pytest.mark.parametrize("threshold, noise", [(0.98, 0.03), (0.9, 0.1)])
def test_clusters(spark, threshold, noise):
    """Clusters of many sizes, chains at the threshold, a hot label, tiles far smaller than a cluster."""
    rng = np.random.default_rng(7)
    rows, label = [], random.Random(3)
    for size in (1, 2, 3, 5, 90, 160):
        for _ in range(3):
            centre = rng.normal(size=24)
            kind = label.choice([0, 0, 0, 1, None])
            for _ in range(size):
                spread = rng.uniform(0, 2) * noise
                rows.append((len(rows), (centre + rng.normal(size=24) * spread).astype(np.float32).tolist(), kind))
    rows += [(10_000 + i, rows[-1][1], rows[-1][2]) for i in range(40)]
    got = near_vectors.near_duplicates(made(spark, rows), threshold=threshold, tile=32)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, threshold)


def test_blocks_drop_no_pair():
    rng = np.random.default_rng(2)
    for size in (1, 3, 8, 20, 70):
        left = near_vectors.unit(rng.normal(size=(40, size)))
        right = near_vectors.unit(np.concatenate([left + rng.normal(size=left.shape) * 0.05, rng.normal(size=(30, size))]))
        i, j = near_vectors.close_pairs(left, right, 0.95)
        assert {(a, b) for a, b in zip(*np.nonzero(left @ right.T >= 0.95))} <= set(zip(i, j))
        assert (left[i] * right[j]).sum(axis=1).min(initial=1) >= 0.95 - 1e-6
