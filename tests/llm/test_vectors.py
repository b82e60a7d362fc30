from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from entitylake.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, times string, node string, ring int"


def plain(rows: list[tuple], least: float = 0.98) -> list[tuple]:
    def unit(row):
        values = row[1]
        if row[2] is None or not values or any(v is None or not math.isfinite(v) for v in values):
            return None
        own = np.array(values, np.float32).astype(float)
        return own / np.linalg.norm(own) if np.linalg.norm(own) > 0 else None

    units = [unit(row) for row in rows]
    n, found = [0] * len(rows), list(range(len(rows)))
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
        and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least
    ]
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if found[i] != found[j]:
                found[i] = found[j] = min(found[i], found[j])
                changed = True
    keys = {}
    for row, c in zip(rows, found):
        if row[0] is not None:
            keys[c] = min(keys.get(c, row[0]), row[0])
    return sorted(((r[0], k, keys.get(c), r[0] == keys.get(c)) for r, k, c in zip(rows, n, found)), key=repr)


def clusters(seed: int, n: int, dim: int, spread: float) -> list[list[float]]:
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(max(n // 8, 1), dim))
    return (centers[draw.integers(0, len(centers), n)] + spread * draw.normal(size=(n, dim))).astype(np.float32).tolist()


def result(frame, **sizes) -> list[tuple]:
    return sorted(map(tuple, vectors.near_duplicates(frame, **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"tile": 7}, {"tile": 40}, {"least": 0.9}])
def test_matches_brute_force(spark, sizes):
    rows = [(i, v, i % 3 if i % 11 else None, "t", "n", 1) for i, v in enumerate(clusters(1, 150, 8, 0.08) + clusters(2, 60, 3, 0.05))]
    rows += [(500 + i, rows[5][1], 2, "t", "n", 1) for i in range(9)] + [(600, [2.0 * x for x in rows[5][1]], 2, None, None, None)]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] * 4, [float("inf")] + [0.0] * 7, [1e-30] * 8, [1.0]]
    rows += [(700 + i, v, 2, "t", "n", 1) for i, v in enumerate(odd)] + [(None, rows[5][1], 2, "t", "n", 1), (None, None, None, None, None, None)]
    rows += [rows[3]] * 2
    frame = spark.createDataFrame(rows, SCHEMA)
    assert result(frame, **sizes) == plain(rows, sizes.get("least", 0.98))


def test_labels_that_look_like_cells(spark):
    rows = [(i, v, label, "t", "n", 1) for i, v in enumerate(clusters(3, 90, 3, 0.05)) for label in ("x", "x.0", "3:x", "")]
    rows = [(i, *row[1:]) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(rows, SCHEMA.replace("label int", "label string"))
    assert result(frame, tile=9) == plain(rows)


def test_one_dense_cluster_is_cut_until_it_fits(spark):
    """Radii at the limit of rounding: cells are cut by a hash, and no link is lost."""
    base = np.random.default_rng(5).normal(size=6)
    rows = [(i, (base + 1e-9 * np.eye(6)[i % 6] * i).tolist(), 1, "t", "n", 1) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>"))
    different = len({tuple(row[1]) for row in rows})
    assert different > 8
    assert sorted(result(frame, tile=8)) == [(i, 59, 0, i == 0) for i in range(60)]


def test_tiles_that_lie_apart_do_not_meet(spark):
    """The pairs of tiles come from the upper levels; of clusters far apart only their own tiles are left."""
    draw = np.random.default_rng(7)
    points = np.concatenate([c + 0.001 * draw.normal(size=(40, 16)) for c in draw.normal(size=(12, 16))])
    rows = [(i, v, 1, "t", "n", 1) for i, v in enumerate(points.astype(np.float32).tolist())]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert result(frame, tile=40) == plain(rows)
    units = vectors._units(frame.select(frame.vec_id.alias("key"), frame.label.cast("string"), frame.embedding.cast("array<double>")))
    classes = units.selectExpr("label", "16 as dim", "node", "1L as times", "unit")
    _, sizes, families = vectors._upper_levels(classes, 40)
    pairs = classes.select(vectors._root().alias("a")).distinct().selectExpr("a", "a as b")
    for level in families:
        pairs = vectors._close_families(pairs, level, 0.2)
    tiles = sizes.count()
    assert tiles >= 12 and pairs.count() <= 3 * tiles < tiles * (tiles + 1) // 2


def test_nothing(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10_000), st.integers(1, 120), st.sampled_from([2, 3, 8]), st.sampled_from([0.0, 0.02, 0.3]))
def test_trees_cover_and_pairs_are_whole(seed, n, dim, spread):
    points = np.array(clusters(seed, n, dim, spread), float)
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = vectors.cover_tree(points, leaf=4)
    assert sorted(tree.order.tolist()) == list(range(n))
    for i in range(len(tree.start)):
        own = tree.points[tree.start[i] : tree.end[i]]
        assert np.linalg.norm(own - own[0], axis=1).max() <= tree.radius[i] + 1e-7
        children = range(tree.first[i], tree.last[i])
        if children:
            assert tree.start[children[0]] == tree.start[i] and tree.end[children[-1]] == tree.end[i]
            assert all(tree.radius[c] <= tree.radius[i] / 2 for c in children)
            centers = tree.points[tree.start[children[0] : children[-1] + 1]]
            apart = np.linalg.norm(centers[:, None] - centers[None, :], axis=2) + 9 * np.eye(len(centers))
            assert apart.min() > tree.radius[i] / 2 - 1e-7
    times = np.arange(1, n + 1)[tree.order]
    links = vectors.Links(tree, tree, times, times, True, 0.95)
    links.traverse()
    near = tree.points @ tree.points.T >= 0.95
    np.fill_diagonal(near, False)
    assert (links.n_a + links.n_b == near @ times).all()
    label = np.arange(n)
    for _ in range(n):
        label = np.minimum(label, np.where(near, label[None, :], n).min(axis=1, initial=n))
    roots = [links.find(i) for i in range(n)]
    assert len(set(zip(roots, label.tolist()))) == len(set(roots)) == len(set(label.tolist()))
