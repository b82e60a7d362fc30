"""Merkle manifest of a data set: trees by source, a tree over the sources, proofs for every row.

Only every ``STRIDE``-th level of a tree is stored. A proof needs the levels between: they are
made again, for one aligned subtree at a time, from the stored nodes below it, and dropped
once the siblings have been emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from entitylake.llm.batches import column, share_code
from entitylake.operators.ranking import ranked
from entitylake.session import materialized

FANOUT = 16
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE = 256  # proofs that travel in one batch

PATH = "array<struct<before: string, after: string>>"


def leaf(values: list[Column]) -> Column:
    """Digest of a row: each value as its byte count, ``:`` and the value, null as ``-``."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _height(count: int, fanout: int) -> int:
    """Levels above the leaves until one node remains."""
    height = 0
    while count > 1:
        count = -(-count // fanout)
        height += 1
    return height


@dataclass
class Tree:
    """Stored levels ``(grp, pos, digest, height, row)`` of the trees of all groups, leaves first.

    Level ``i`` holds the nodes ``i * stride`` levels above the leaves, but at most those at the
    top of their tree: a group appears up to the level where a single node of it remains.
    """

    levels: list[DataFrame]
    fanout: int
    stride: int

    @property
    def tops(self) -> DataFrame:
        """``(grp, digest)``: the node that remains of each group."""
        found = [level.where(f"height <= {i * self.stride}").select("grp", "digest") for i, level in enumerate(self.levels)]
        top = found[0]
        for other in found[1:]:
            top = top.union(other)
        return top


def _run(members: list[str], fanout: int) -> list[str]:
    return ["".join(members[i : i + fanout]) for i in range(0, len(members), fanout)]


def _subtrees(nodes: DataFrame, level: int, fanout: int, stride: int) -> DataFrame:
    """The nodes below each aligned subtree, at most ``fanout ** stride`` of them, in one row."""
    span = fanout**stride
    under = nodes.where(f"height > {level * stride}")
    return under.groupBy("grp", F.expr(f"pos div {span}").alias("block")).agg(
        F.first("height").alias("height"),
        F.collect_list(F.struct("pos", "digest", "row")).alias("members"),
    )


def _tops_of(subtrees: DataFrame, level: int, fanout: int, stride: int) -> DataFrame:
    """The node at the top of each subtree; what lies between is made and dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for members, height in zip(batch.column("members"), batch.column("height").to_pylist()):
                _, found = _ordered(members)
                for _ in range(min(stride, height - level * stride)):
                    found = [sha256(run.encode()).hexdigest() for run in _run(found, fanout)]
                (top,) = found
                digests.append(bytes.fromhex(top))
            columns = [batch.column(name) for name in ("grp", "block", "height")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], ["grp", "pos", "height", "digest"])

    kind = subtrees.schema["grp"].dataType.simpleString()
    return subtrees.mapInArrow(run, f"grp {kind}, pos long, height int, digest binary")


def _ordered(members: pa.Scalar) -> tuple[pa.StructArray, list[str]]:
    """The members of a subtree by position, and their digests as text."""
    values = members.values
    order = pa.compute.array_sort_indices(values.field("pos"))
    values = values.take(order)
    return values, [digest.hex() for digest in values.field("digest").to_pylist()]


def grown(leaves: DataFrame, order_by: str, fanout: int = FANOUT, stride: int = STRIDE) -> Tree:
    """Trees over ``leaves (grp, digest, row)``, leaves in the order ``order_by``; equal places may swap.

    Leaves are numbered without gathering a group: see ``ranking.ranked``. Every later level is
    made from the stored one below, subtree by subtree.
    """
    share_code(leaves.sparkSession)
    leaves = materialized(leaves, "leaves")  # ranking reads them twice
    counts = leaves.groupBy("grp").agg(F.count("*").alias("n"))
    height, bound = F.lit(0), 1
    for step in range(1, 64):
        bound *= fanout
        if bound // fanout >= 1 << 62:
            break
        height = height + F.when(F.col("n") > bound // fanout, 1).otherwise(0)
    heights = materialized(counts.select("grp", height.cast("int").alias("height")), "heights")
    numbered = ranked(leaves, order_by, "rank", group="grp").select("grp", (F.col("rank") - 1).alias("pos"), "digest", "row")
    levels = [materialized(numbered.join(heights, "grp"), "level")]
    tallest = heights.agg(F.max("height")).first()[0] or 0
    for i in range(-(-tallest // stride)):
        top = _tops_of(_subtrees(levels[i], i, fanout, stride), i, fanout, stride)
        levels.append(materialized(top.select("grp", "pos", "digest", "height", F.lit(None).cast("int").alias("row")), "level"))
    return Tree(levels, fanout, stride)


def proofs(tree: Tree, above: DataFrame) -> DataFrame:
    """``(row, digest, path, above)`` for every leaf.

    ``above (grp, path, above)`` continues the paths beyond the groups' tops. A path has an entry per
    level, lowest first: the digests left and right of the own node in its run, joined.
    From the top down, each stored level gets its paths from the one above it.
    """
    fanout, stride = tree.fanout, tree.stride

    def walked(pairs: DataFrame, level: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for place in range(batch.num_rows):
                    values, found = _ordered(batch.column("members")[place])
                    height = batch.column("height")[place].as_py()
                    rest = [(step["before"], step["after"]) for step in batch.column("path")[place].as_py()]
                    layers = []  # the missing levels, regenerated from the stored nodes
                    for _ in range(min(stride, height - level * stride)):
                        runs = _run(found, fanout)
                        layers.append(runs)
                        found = [sha256(members.encode()).hexdigest() for members in runs]
                    for start in range(0, len(values), SLICE):
                        own = values.slice(start, SLICE)
                        before, after = [], []
                        for i in range(start, start + len(own)):
                            for runs in layers:
                                i, at = divmod(i, fanout)
                                before.append(runs[i][: 64 * at])
                                after.append(runs[i][64 * at + 64 :])
                            before.extend(step[0] for step in rest)
                            after.extend(step[1] for step in rest)
                        steps = len(layers) + len(rest)
                        paths = pa.ListArray.from_arrays(
                            pa.array(range(0, steps * len(own) + 1, steps) if steps else [0] * (len(own) + 1), pa.int32()),
                            pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"]),
                        )
                        same = pa.array([0] * len(own), pa.int32())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("grp").take(pa.array([place] * len(own))), own.field("pos"), own.field("digest"),
                             own.field("row"), paths, batch.column("above").slice(place, 1).take(same)],
                            ["grp", "pos", "digest", "row", "path", "above"],
                        )

        kinds = {name: pairs.schema[name].dataType.simpleString() for name in ("grp", "above")}
        row = tree.levels[level].schema["row"].dataType.simpleString()
        return pairs.mapInArrow(run, f"grp {kinds['grp']}, pos long, digest binary, row {row}, path {PATH}, above {kinds['above']}")

    known = None
    for level in range(len(tree.levels) - 1, -1, -1):
        nodes = tree.levels[level]
        tops = nodes.where(f"height <= {level * stride}").join(above, "grp")
        found = tops.select("grp", "pos", "digest", "row", "path", "above")
        if known is not None:
            subtrees = _subtrees(nodes, level, fanout, stride)
            parents = known.select("grp", F.col("pos").alias("block"), "path", "above")
            found = found.union(walked(subtrees.join(parents, ["grp", "block"]), level))
        known = materialized(found, "paths") if level else found
    return known


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(
    docs: DataFrame, carried: dict[str, Column] | None = None, key: str = "doc_id", source: str = "source",
    fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT, stride: int = STRIDE,
) -> DataFrame:
    """``(key, <carried>, leaf, subroot, root, path)`` per row; ``path`` is the row's proof.

    A leaf is the digest of ``fields``. Within a source leaves ascend by key, null first; equal
    keys by leaf, so rows that are alike in all fields may swap places and nothing else may.
    Every ``fanout`` consecutive nodes become the digest of their joined digests until one is
    left, the source's ``subroot``; a source with one row has its leaf there. Subroots ascend by
    source, null first, by their bytes, and become ``root`` alike. An empty table gives no rows.
    ``carried`` are expressions over ``docs`` that are kept beside the key; other columns of
    ``docs`` play no part, whatever their names are.
    """
    extra = dict(carried or {})
    own = docs.select(
        column(docs, key).alias("key"),
        column(docs, source).alias("source"),
        F.unhex(leaf([column(docs, name) for name in fields])).alias("digest"),
        *[value.alias(f"c{i}") for i, value in enumerate(extra.values())],
    )
    # a group of null would have no ranks
    grp = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-"))
    row = F.struct("key", *[f"c{i}" for i in range(len(extra))])
    by_source = grown(own.select(grp.alias("grp"), "digest", row.alias("row"), "key"), "key, digest", fanout, stride)
    tops = by_source.tops.select(
        F.lit(0).alias("grp"), "digest", F.col("grp").alias("row"), F.when(F.col("grp") != "-", F.expr("substr(grp, 2)")).alias("source")
    )
    over = grown(tops, "source", fanout, stride)
    end = over.tops.select(
        "grp", F.array().cast(PATH).alias("path"), F.struct(F.lower(F.hex("digest")).alias("root")).alias("above")
    )
    sources = proofs(over, end)
    above = F.struct(F.lower(F.hex("digest")).alias("subroot"), F.col("above.root").alias("root"))
    rows = proofs(by_source, materialized(sources.select(F.col("row").alias("grp"), "path", above.alias("above")), "above"))
    return rows.select(
        F.col("row.key").alias(key),
        *[F.col(f"row.c{i}").alias(name) for i, name in enumerate(extra)],
        F.lower(F.hex("digest")).alias("leaf"),
        "above.subroot",
        "above.root",
        "path",
    )


def tampered_leaf(docs: DataFrame) -> Column:
    """The leaf of a row whose text is lower-cased, for one row in five by its key; null for the others."""
    key = column(docs, "doc_id").cast("string")
    chosen = F.crc32(key) % 5 == 0
    changed = [F.translate(column(docs, name), UPPER, LOWER) if name == "text" else column(docs, name) for name in FIELDS]
    return F.unhex(F.when(chosen, leaf(changed)))


def audited(docs: DataFrame) -> DataFrame:
    """The manifest, and for every row whether it still leads to the root after some were tampered with.

    Rows without a key are not tampered with.
    """
    rows = manifest(docs, {"tampered": tampered_leaf(docs)})
    start = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
