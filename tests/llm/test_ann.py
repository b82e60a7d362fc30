from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from entitylake.llm import ann
from entitylake.llm.ann import Coder, MultiIndex, hamming

SCHEMA = "vec_id long, embedding array<float>, label int, node string, key string, rank int, least int"


def plain(rows: list[tuple], every: int, k: int) -> list[tuple]:
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    own = [(key, np.array(v, np.float32).astype(float)) for key, v in rows if usable(v)]
    found = []
    for i, (query, a) in enumerate(own):
        if query is None or query % every:
            continue
        near = [
            (float(np.sqrt(((a - b) ** 2).sum())), key is not None, key) for j, (key, b) in enumerate(own) if j != i and len(a) == len(b)
        ]
        for rank, (score, _, key) in enumerate(sorted(near, key=lambda r: (r[0], r[1], r[2] or 0))[:k]):
            found.append((query, rank + 1, key, score))
    return sorted(found, key=repr)


def result(frame, **sizes) -> list[tuple]:
    return sorted(map(tuple, ann.nearest(frame, **sizes).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, "n", "k", 2, 3) for row in rows], SCHEMA)


def some(seed: int, n: int, dim: int) -> list[list[float]]:
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32).tolist()


def close(got: list[tuple], expected: list[tuple]) -> None:
    assert [row[:3] for row in got] == [row[:3] for row in expected]
    assert all(a[3] == pytest.approx(b[3], rel=1e-12) for a, b in zip(got, expected))


def test_copies_ties_and_odd_rows(spark):
    """The radius is wide enough here for whole results, so they equal brute force."""
    vectors = some(1, 60, 8)
    rows = [(i * 10, v) for i, v in enumerate(vectors)]
    rows += [(7, vectors[0])] * 2 + [(1000 + i, vectors[10]) for i in range(30)] + [(100, vectors[10])] + [(None, vectors[0]), (None, None)]
    odd = [None, [], [0.0] * 8, [-0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [float("inf")] + [0.0] * 7]
    rows += [(2000 + 100 * i, v) for i, v in enumerate(odd)]
    rows += [(3000, [1.0, 2.0]), (3001, [1.0, 2.5]), (3100, [5.0]), (3200, [-1.0] + [0.0] * 7), (-100, [-1.0] + [-0.0] * 7)]
    frame = table(spark, rows)
    close(result(frame, sample=40, radius=255), plain(rows, 100, 10))
    close(result(frame, radius=256, block=16, k=3, every=7), plain(rows, 7, 3))


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0] * 4)], [(i, [1.0] * 4) for i in range(30)], [(1, [1.0]), (2, [2.0])]])
def test_few_and_equal_vectors(spark, rows):
    close(result(table(spark, rows)), plain(rows, 100, 10))


def test_recall_against_brute_force(spark):
    rows = list(enumerate(some(5, 3000, 32)))
    frame = table(spark, rows)
    expected = {row[:1] + row[2:3] for row in plain(rows, 100, 10)}
    found = {row[:1] + row[2:3] for row in result(frame, sample=1000, block=256)}
    assert len(found) == 300 and len(found & expected) >= 0.9 * 300


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10_000), st.integers(1, 80), st.sampled_from([8, 16]), st.integers(0, 70), st.floats(0.02, 0.5))
def test_probing_loses_no_code_within_the_radius(seed, n, width, radius, share):
    draw = np.random.default_rng(seed)
    codes = np.packbits(draw.random((n, 8 * width)) < share, axis=1)
    asked = codes[:5] ^ np.packbits(draw.random((len(codes[:5]), 8 * width)) < 0.1, axis=1)
    pairs = set(zip(*(x.tolist() for x in MultiIndex(codes).within(asked, radius))))
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(hamming(asked, codes) <= radius))))


def test_rotations_are_learned_and_the_radius_covers_neighbours():
    vectors = np.random.default_rng(1).normal(size=(800, 24)) * np.linspace(3, 0.2, 24)
    coder = Coder.fitted(vectors, 10)
    square = coder.rotations[:, :24]
    assert np.allclose(square.T @ square, np.eye(24), atol=1e-8)
    codes = coder.codes(vectors)
    assert codes.shape == (800, 32) and 0 < coder.radius < 256
    apart = np.linalg.norm(vectors[:, None] - vectors[None], axis=2) + 1e9 * np.eye(800)
    near = np.argsort(apart, axis=1)[:, :10]
    inside = np.take_along_axis(hamming(codes, codes), near, axis=1) <= coder.radius
    assert inside.mean() >= 0.95


def test_blocks_that_lie_apart_are_not_searched(spark):
    """Two far clusters: shared bits of their blocks already differ in more than the radius."""
    draw = np.random.default_rng(2)
    ends = [(0.01 * draw.normal(size=(64, 16)) + shift).astype(np.float32).tolist() for shift in (-5, 5)]
    rows = list(enumerate(ends[0] + ends[1]))
    close(result(table(spark, rows), block=16, k=3), plain(rows, 100, 3))
