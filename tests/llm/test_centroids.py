from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from entitylake.llm import centroids
from entitylake.llm.centroids import Orchard

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, key string, point int, v int"


def plain(rows: list[tuple], k: int = 16, rounds: int = 3, dim: int = 64) -> list[tuple]:
    fine = lambda v: v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    kept = [(r[0], [math.floor(64 * float(np.float32(x))) for x in r[1]]) for r in rows if fine(r[1])]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((square(v, c), i) for i, c in enumerate(middle))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, own in groups.items():
            middle[i] = [sum(column) // len(own) for column in zip(*own)]
    found = [(key, *nearest(v)) for key, v in kept]
    sums = {}
    for _, d, i in found:
        sums[i] = sums.get(i, 0) + d
    name = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((key, i, d, sums[i], sum(sums.values()), name[i]) for key, d, i in found), key=repr)


def result(frame, **sizes) -> list[tuple]:
    return sorted(map(tuple, centroids.clustered(frame, **sizes).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, "c", "k", 2, 3) for row in rows], SCHEMA)


def some(seed: int, n: int, dim: int = 64) -> list[list[float]]:
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, dim)) / 4).astype(np.float32).tolist()


def test_matches_brute_force_on_odd_rows(spark):
    vectors = some(1, 120)
    rows = list(enumerate(vectors)) + [(500 + i, vectors[3]) for i in range(40)] + [(7, vectors[7])] * 3
    odd = [None, [], [0.0] * 64, [0.5] * 63, [0.5] * 65, [float("nan")] * 64, [1.0, None] * 32, [float("-inf")] + [0.0] * 63]
    rows += [(900 + i, v) for i, v in enumerate(odd)] + [(None, vectors[5]), (None, None), (-3, vectors[9])]
    assert result(table(spark, rows)) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.25] * 64)], [(i, [0.25] * 64) for i in range(30)]])
def test_few_and_equal_vectors(spark, rows):
    assert result(table(spark, rows)) == plain(rows)


def test_own_sizes_and_huge_components(spark):
    rows = list(enumerate(some(2, 80, 3)))
    assert result(table(spark, rows), k=5, rounds=2, dim=3) == plain(rows, 5, 2, 3)
    huge = result(table(spark, [*rows, (99, [1e38, -1e38, 0.0])]), k=5, rounds=1, dim=3)
    assert len(huge) == 81 and all(row[2] >= 0 and row[3] <= row[4] for row in huge)


def test_watched_centroids(spark):
    seen = []
    centroids.clustered(table(spark, list(enumerate(some(3, 50)))), watch=seen.append)
    assert len(seen) == 4 and all(len(round) == 16 for round in seen)


@settings(deadline=None, max_examples=80)
@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 4), st.integers(1, 6))
def test_orchard_finds_the_nearest_and_the_smaller_number(seed, k, dim, spread):
    draw = np.random.default_rng(seed)
    middle = draw.integers(-spread, spread + 1, size=(k, dim))
    points = draw.integers(-spread - 2, spread + 3, size=(60, dim))
    found, near = Orchard(middle.tolist()).search(points)
    apart = ((points[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (near == apart.min(axis=1)).all()
