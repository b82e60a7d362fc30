"""Near-duplicate embeddings: exact threshold links by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_128_digest

from entitylake.llm.batches import column, share_code
from entitylake.llm.links import components
from entitylake.session import materialized

LEAST = 0.98
TILE = 2048
LEAF = 16
FANOUT = 64
SAMPLE = 1024
DEPTH = 12
SLACK = 1e-7  # bounds are loosened by this much, so that rounding never prunes a link


@dataclass
class CoverTree:
    """Points in tree order; a node covers ``points[start:end]`` and its centre is the first of them.

    Nodes are numbered so that a node's children are ``first:last``; a node without children is a leaf.
    """

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """Nested levels: a node's children are centred on points that lie further than half its radius
    apart, and each takes the points within that half; so radii halve from level to level.
    """
    order = np.arange(len(points))

    def distances(center: int, others: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (points[others] @ points[center]), 0))

    start, end, radius, first, last = [0], [len(points)], [0.0], [0], [0]
    if len(points):
        radius[0] = float(distances(order[0], order).max())
    node = 0
    while node < len(start):
        a, b, reach = start[node], end[node], radius[node] / 2
        if b - a > leaf and radius[node] > SLACK:
            first[node] = len(start)
            rest, place = order[a:b].copy(), a
            while len(rest):
                far = distances(rest[0], rest)
                far[0] = 0.0
                near = far <= reach
                own = rest[near]
                order[place : place + len(own)] = own
                start.append(place)
                place += len(own)
                end.append(place)
                radius.append(float(far[near].max()))
                first.append(0)
                last.append(0)
                rest = rest[~near]
            last[node] = len(start)
        node += 1
    arrays = (np.array(x) for x in (start, end, radius, first, last))
    return CoverTree(points[order], order, *arrays)


def _spread(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns: equal if links connect them, the row count where nothing does."""
    left, right = np.where(near.any(axis=1), np.arange(len(near)), len(near)), None
    while True:
        right = np.where(near, left[:, None], len(near)).min(axis=0)
        new = np.minimum(left, np.where(near, right[None, :], len(near)).min(axis=1))
        if (new == left).all():
            return left, right
        left = new


class Links:
    """Weighted link counts of the points of two trees, and which points links connect."""

    def __init__(self, a: CoverTree, b: CoverTree, times_a: np.ndarray, times_b: np.ndarray, same: bool, least: float):
        self.a, self.b, self.same, self.least = a, b, same, least
        self.times_a, self.times_b = times_a, times_b
        self.n_a, self.n_b = np.zeros(len(times_a), np.int64), np.zeros(len(times_b), np.int64)
        self.parent = list(range(len(times_a) + (0 if same else len(times_b))))
        self.reach = sqrt(2 - 2 * least)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def compare(self, i: int, j: int) -> None:
        """All points of two nodes, by cosine."""
        a, b = self.a, self.b
        rows, columns = slice(a.start[i], a.end[i]), slice(b.start[j], b.end[j])
        near = a.points[rows] @ b.points[columns].T >= self.least
        if self.same and i == j:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.n_a[rows] += near @ self.times_b[columns]
        if not (self.same and i == j):
            self.n_b[columns] += self.times_a[rows] @ near
        left, right = _spread(near)
        shift = 0 if self.same else len(self.n_a)
        for labels, begin in ((left, a.start[i]), (right, b.start[j] + shift)):
            for place in np.flatnonzero(labels < len(near)):
                self.join(int(a.start[i] + labels[place]), int(begin + place))

    def single(self, own: np.ndarray, right: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Which pairs of nodes are of one point each; of these, those that are ``near`` get their links at once."""
        a, b = self.a, self.b
        alone = (a.end[own] - a.start[own] == 1)[:, None] & (b.end[right] - b.start[right] == 1)[None, :]
        x, y = np.nonzero(near & alone)
        x, y = a.start[own[x]], b.start[right[y]]
        if self.same:
            x, y = x[x != y], y[x != y]
        np.add.at(self.n_a, x, self.times_b[y])
        np.add.at(self.n_b, y, self.times_a[x])
        for one, other in zip(x.tolist(), (y if self.same else y + len(self.n_a)).tolist()):
            self.join(one, other)
        return alone

    def traverse(self) -> None:
        """From the roots down: pairs of nodes whose covers lie apart are pruned; others are split,
        the wider node first, and pairs of leaves compared."""
        if not len(self.n_a) or not len(self.n_b):
            return
        a, b, pairs = self.a, self.b, [(0, 0)]
        while pairs:
            i, j = pairs.pop()
            wide_a, wide_b = a.last[i] > a.first[i], b.last[j] > b.first[j]
            if not wide_a and not wide_b:
                self.compare(i, j)
                continue
            split_a = wide_a and (not wide_b or a.radius[i] >= b.radius[j])
            split_b = wide_b and (not wide_a or b.radius[j] >= a.radius[i] / 2)
            left = np.arange(a.first[i], a.last[i]) if split_a else np.array([i])
            right = np.arange(b.first[j], b.last[j]) if split_b else np.array([j])
            rows = max(1, (1 << 22) // len(right))
            for k in range(0, len(left), rows):
                own = left[k : k + rows]
                dots = a.points[a.start[own]] @ b.points[b.start[right]].T
                apart = np.sqrt(np.maximum(2 - 2 * dots, 0))
                bound = self.reach + SLACK + a.radius[own][:, None] + b.radius[right][None, :]
                close = apart <= bound
                if self.same and i == j:  # each pair of children once
                    close &= own[:, None] <= right[None, :]
                close &= ~self.single(own, right, close & (dots >= self.least))
                x, y = np.nonzero(close)
                pairs.extend(zip(own[x].tolist(), right[y].tolist()))


def _tree_columns(tree: CoverTree) -> list[bytes]:
    return [x.astype(t).tobytes() for x, t in ((tree.start, "<i4"), (tree.end, "<i4"), (tree.radius, "<f8"), (tree.first, "<i4"), (tree.last, "<i4"))]


def _units(rows: DataFrame) -> DataFrame:
    """Adds the unit vector in double precision, null if there is none, and a name for it and its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, nodes = [], []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2)):
                values = vector.values if label is not None and vector.is_valid else None
                unit = None
                if values is not None and len(values) and not values.null_count:
                    own = values.to_numpy().astype(np.float64)
                    peak = np.abs(own).max()
                    if np.isfinite(own).all() and peak > 0:
                        own = own / peak
                        unit = (own / sqrt(own @ own)).astype("<f8").tobytes()
                units.append(unit)
                nodes.append(None if unit is None else xxh3_128_digest(label.encode() + b"\0" + unit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(units, pa.binary()), pa.array(nodes, pa.binary())],
                ["key", "label", "unit", "node"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, label string, unit binary, node binary")


def _net(points: np.ndarray, fewest: int, most: int = FANOUT) -> np.ndarray:
    """Places of points, each the farthest from those before, until all lie within half the radius
    that the first one has. If ``most`` do not get that far, the first ``fewest``: more would
    prune nothing, but make more pairs."""
    far = np.sqrt(np.maximum(2 - 2 * (points @ points[0]), 0))
    half, chosen = float(far.max()) / 2, [0]
    while len(chosen) < most and far.max() > max(half, SLACK):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(np.maximum(2 - 2 * (points @ points[chosen[-1]]), 0)))
    return np.array(chosen if far.max() <= max(half, SLACK) else chosen[:fewest])


def _centres(sampled: DataFrame) -> DataFrame:
    """``(cell, centres)`` of ``(cell, dim, fewest, units)``: the centres of a cell's children, in a row of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                points = np.frombuffer(b"".join(sorted(row["units"])), "<f8").reshape(-1, row["dim"])
                found.append(points[_net(points, row["fewest"])].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(found, pa.binary())], ["cell", "centres"])

    return sampled.mapInArrow(run, "cell string, centres binary")


def _dealt(chunks: DataFrame) -> DataFrame:
    """The members of ``(cell, dim, members, centres)`` with the child whose centre is nearest, and how far that is."""
    names = ["cell", "dim", "node", "times", "unit", "parent", "centre", "far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                parent, dim = batch.column("cell")[place].as_py(), batch.column("dim")[place].as_py()
                members = batch.column("members")[place].values.flatten()
                centres = np.frombuffer(batch.column("centres")[place].as_py(), "<f8").reshape(-1, dim)
                points = np.frombuffer(b"".join(members[2].to_pylist()), "<f8").reshape(-1, dim)
                dots = points @ centres.T
                near = dots.argmax(axis=1)
                far = np.sqrt(np.maximum(2 - 2 * dots[np.arange(len(near)), near], 0))
                n = len(near)
                cells, ends = [f"{parent}.{i}" for i in range(len(centres))], [row.tobytes() for row in centres]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cells[i] for i in near]), pa.array([dim] * n, pa.int32()), *members,
                        pa.array([parent] * n), pa.array([ends[i] for i in near], pa.binary()), pa.array(far),
                    ],
                    names,
                )

    return chunks.mapInArrow(
        run, "cell string, dim int, node binary, times long, unit binary, parent string, centre binary, far double"
    )


def _root() -> Column:
    """The cell of all vectors of a label and dimension."""
    return F.concat(F.col("dim").cast("string"), F.lit(":"), F.sha2("label", 256))


def _upper_levels(classes: DataFrame, tile: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """``points (cell, dim, node, times, unit)``, ``sizes (cell, n_tiles)`` and, level by level,
    the families ``(parent, members)`` of the upper tree, members with cell, centre and radius.

    A group of equal label and dimension is the root's cell. A cell with more than ``tile`` vectors has
    children around centres that cover a sample of it, drawn by a hash, at half its radius, if up to ``FANOUT``
    do, else around as few as make tiles; every
    vector goes to the nearest, and the covering radius is that of all vectors. Cells beyond ``DEPTH``
    levels, and those whose vectors agree but for rounding, are cut by a hash. At a level, a cell without children
    is a family of its own, so pairs of families of one level cover all pairs.
    """
    points = classes.select(
        _root().alias("cell"), "dim", "node", "times", "unit",
        F.lit(None).cast("string").alias("parent"), F.lit(b"").alias("centre"), F.lit(2.0).alias("far"),
    )
    settled, counts, families = [], [], []
    done = None
    for depth in range(DEPTH + 1):
        points = materialized(points, "level")
        sizes = points.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("far").alias("radius"), F.first("centre").alias("centre"),
            F.first("parent").alias("parent"),
        )
        wide = (F.col("n") > tile) & (F.col("radius") > SLACK) & F.lit(depth < DEPTH)
        sizes = materialized(sizes.withColumn("inner", wide), "cells")
        if depth:
            own = sizes.select("parent", "cell", "centre", "radius")
            if done is not None:  # cells of higher levels without children stand for themselves
                own = own.union(done.select(F.col("cell").alias("parent"), "cell", "centre", "radius"))
            member = F.sort_array(F.collect_list(F.struct("cell", "centre", "radius")))
            family = own.groupBy("parent").agg(member.alias("members"))
            families.append(materialized(family, "families"))
        leaves = sizes.where(~F.col("inner"))
        settled.append(points.join(leaves.select("cell"), "cell"))
        counts.append(leaves.select("cell", F.ceil(F.col("n") / tile).cast("int").alias("n_tiles")))
        done = leaves if done is None else done.union(leaves)
        inner = sizes.where("inner")
        if inner.isEmpty():
            break
        fewest = F.least(F.lit(FANOUT), F.greatest(F.lit(2), F.ceil(1.5 * F.col("n") / tile))).cast("int")
        chunk = F.expr(f"pmod(xxhash64(node, 'chunk'), int(ceil(n / {tile})))")
        rows = points.drop("parent", "centre", "far").join(inner.select("cell", "n", fewest.alias("fewest")), "cell")
        drawn = F.expr(f"pmod(xxhash64(node, {depth}), greatest(n div {SAMPLE}, 1)) = 0")
        sampled = rows.where(drawn).groupBy("cell").agg(
            F.first("dim").alias("dim"), F.first("fewest").alias("fewest"), F.collect_list("unit").alias("units")
        )
        members = rows.groupBy("cell", "dim", chunk.alias("chunk")).agg(
            F.collect_list(F.struct("node", "times", "unit")).alias("members")
        )
        centres = materialized(_centres(sampled), "centres")
        points = _dealt(members.join(centres, "cell").select("cell", "dim", "members", "centres"))
    names = ["cell", "dim", "node", "times", "unit"]
    union = lambda frames: reduce(DataFrame.union, frames)
    return union([frame.select(*names) for frame in settled]), union(counts), families


def _close_families(pairs: DataFrame, families: DataFrame, reach: float) -> DataFrame:
    """One level down: the pairs of children of ``pairs (a, b)`` whose covers do not lie apart, each once."""
    own = lambda side: families.select(F.col("parent").alias(side), F.col("members").alias(f"of_{side}"))
    joined = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sides = []
                for members in (row["of_a"], row["of_b"]):
                    centres = np.frombuffer(b"".join(m["centre"] for m in members), "<f8").reshape(len(members), -1)
                    sides.append(([m["cell"] for m in members], centres, np.array([m["radius"] for m in members])))
                (a, at_a, wide_a), (b, at_b, wide_b) = sides
                if at_a.shape[1] and at_b.shape[1]:
                    apart = np.sqrt(np.maximum(2 - 2 * (at_a @ at_b.T), 0))
                    close = apart <= reach + SLACK + wide_a[:, None] + wide_b[None, :]
                else:  # a root has no centre
                    close = np.ones((len(a), len(b)), bool)
                if row["a"] == row["b"]:
                    close = np.triu(close)
                x, y = np.nonzero(close)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[i] for i in x], pa.string()), pa.array([b[i] for i in y], pa.string())], ["a", "b"]
                )

    return joined.mapInArrow(run, "a string, b string")


def _grown(tiles: DataFrame, place: list[str]) -> DataFrame:
    """A cover tree for every tile; points and their names come in tree order."""
    parts = ["start", "end", "radius", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members")[row].as_py()
                dim = batch.column("dim")[row].as_py()
                points = np.frombuffer(b"".join(m["unit"] for m in members), "<f8").reshape(-1, dim)
                tree = cover_tree(points)
                ordered = [members[i] for i in tree.order.tolist()]
                nodes, times = [m["node"] for m in ordered], [m["times"] for m in ordered]
                values = [[nodes], [times], [tree.points.astype("<f8").tobytes()], *([x] for x in _tree_columns(tree))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).slice(row, 1) for name in place), *map(pa.array, values)],
                    [*place, "nodes", "times", "points", *parts],
                )

    return tiles.mapInArrow(
        run,
        "cell string, dim int, tile int, nodes array<binary>, times array<long>, points binary, "
        "start binary, end binary, radius binary, first binary, last binary",
    )


def links(classes: DataFrame, least: float = LEAST, tile: int = TILE) -> DataFrame:
    """``(node, other, linked)`` for ``classes (label, dim, node, times, unit)`` of different vectors.

    ``linked`` counts a node's links to others, each as many times as the other has copies;
    ``other`` is one node that links reach. A node may have several rows. Only vectors of equal
    label and dimension are compared.

    The upper levels of a group's cover tree are tables of cells (``_upper_levels``); each cell without
    children is a tile with its own tree. Pairs of cells are walked down from the roots, level by
    level, on centres and radii alone; the points of two tiles meet only if their covers do.
    """
    share_code(classes.sparkSession)
    reach = sqrt(2 - 2 * least)
    points, sizes, families = _upper_levels(classes, tile)
    place = ["cell", "dim", "tile"]
    packed = (
        points.join(sizes, "cell")
        .groupBy("cell", "dim", F.expr("pmod(xxhash64(node), n_tiles)").cast("int").alias("tile"))
        .agg(F.collect_list(F.struct("node", "times", "unit")).alias("members"))
    )
    trees = materialized(_grown(packed, place), "trees")
    pairs = classes.select(_root().alias("a")).distinct().withColumn("b", F.col("a"))
    for level in families:
        pairs = materialized(_close_families(pairs, level, reach), "pairs")
    tiles = lambda side: sizes.select(F.col("cell").alias(side), F.col("n_tiles").alias(f"n_{side}"))
    own = [F.col(name).alias(f"a_{name}") for name in trees.columns if name not in ("cell", "dim", "tile")]
    pairs = (
        pairs.join(tiles("a"), "a").join(tiles("b"), "b")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)))
        .where((F.col("a") != F.col("b")) | (F.col("j") >= F.col("i")))
        .select("a", "b", "i", "j", ((F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))).alias("same"))
        .join(trees.select(F.col("cell").alias("a"), F.col("tile").alias("i"), *own), ["a", "i"])
        .join(trees.select(F.col("cell").alias("b"), F.col("tile").alias("j"), "dim", *(n for n in trees.columns if n not in place)), ["b", "j"])
        .drop("a", "b", "i", "j")
    )

    def read(row: dict, dim: int, prefix: str = "") -> CoverTree:
        points = np.frombuffer(row[prefix + "points"], "<f8").reshape(-1, dim)
        kinds = (("start", "<i4"), ("end", "<i4"), ("radius", "<f8"), ("first", "<i4"), ("last", "<i4"))
        return CoverTree(points, None, *(np.frombuffer(row[prefix + name], kind) for name, kind in kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = {name: batch.column(name)[place].as_py() for name in batch.schema.names}
                dim, same = row["dim"], row["same"]
                a, b = read(row, dim, "a_"), read(row, dim)
                found = Links(a, b, np.array(row["a_times"]), np.array(row["times"]), same, least)
                found.traverse()
                nodes = row["a_nodes"] if same else row["a_nodes"] + row["nodes"]
                linked = found.n_a + found.n_b if same else np.r_[found.n_a, found.n_b]
                used = np.flatnonzero(linked)
                if len(used):
                    others = [nodes[found.find(int(i))] for i in used]
                    columns = [pa.array([nodes[i] for i in used]), pa.array(others), pa.array(linked[used])]
                    yield pa.RecordBatch.from_arrays(columns, ["node", "other", "linked"])

    return pairs.mapInArrow(run, "node binary, other binary, linked long")


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = LEAST, tile: int = TILE,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` per row.

    Rows with equal labels are linked if their vectors' cosine is ``least`` or more; no pair is
    missed. Rows whose label or vector is null, or whose vector is empty, zero or holds null or
    non-finite components, are linked with nothing. ``n_links`` counts rows, copies of the vector
    included; ``component_id`` is the smallest key that links reach and a row is ``kept`` if that
    is its own. Rows without a key are never named by a component unless all of its rows lack one.
    """
    share_code(rows.sparkSession)
    chosen = rows.select(
        column(rows, key).alias("key"),
        column(rows, label).cast("string").alias("label"),
        column(rows, vector).cast("array<double>").alias("vector"),
    )
    own = materialized(_units(chosen), "units")
    classes = materialized(
        own.where(F.col("node").isNotNull())
        .groupBy("label", "node")
        .agg(F.count("*").alias("times"), F.min("key").alias("least"), F.first("unit").alias("unit"))
        .withColumn("dim", (F.length("unit") / 8).cast("int")),
        "classes",
    )
    found = materialized(links(classes, least, tile), "links")
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    slim = classes.select("node", "times", "least").join(counts, "node", "left").join(roots, "node", "left")
    slim = materialized(slim.withColumn("root", F.coalesce("root", "node")), "nodes")
    # written, so that adaptive execution can split a large component in the join
    first = materialized(slim.groupBy("root").agg(F.min("least").alias("component")), "first")
    named = materialized(
        slim.join(first, "root").select("node", "component", (F.col("times") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")),
        "nodes",
    )
    inside = own.select("key", "node").where(F.col("node").isNotNull()).join(named, "node").select("key", "n_links", "component")
    alone = own.where(F.col("node").isNull()).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component"))
    return inside.union(alone).select(
        F.col("key").alias(key), "n_links", F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )
