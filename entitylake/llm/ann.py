"""Approximate nearest neighbours: learned binary codes under a multi-index of their substrings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from xxhash import xxh3_128_digest

from entitylake.llm.batches import column, share_code
from entitylake.operators.ranking import ranked
from entitylake.session import materialized

K, EVERY = 10, 100
SAMPLE = 8192  # vectors that rotations and radius are learned from, those with the smallest hashes
PROBES = 512  # vectors of the sample whose neighbours in it give the radius
MISSED = 0.02  # share of the sample's neighbours that may lie outside the radius
BITS = 256
STEPS = 20
CHUNK = 16  # bits of a substring
BLOCK, ASKED = 2048, 256  # codes in a block of the index, and of the queries
PAIRS = 1 << 16  # vectors that are compared at once


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each code of ``a`` and each of ``b``, codes as rows of bytes."""
    a, b = (np.ascontiguousarray(x).view("<u8") for x in (a, b))
    out = np.zeros((len(a), len(b)), np.int32)
    for word in range(a.shape[1]):
        out += np.bitwise_count(a[:, word, None] ^ b[None, :, word])
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``a`` from the same row of ``b``."""
    apart = a - b
    return np.sqrt((apart * apart).sum(axis=1))


@dataclass
class Coder:
    """Rotations that turn a vector into signs, and the radius that neighbours' codes lie within."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Rows of bytes, padded with zero bits to whole words of 64."""
        bits = (vectors - self.mean) @ self.rotations >= 0
        return np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1)

    @classmethod
    def fitted(cls, vectors: np.ndarray, k: int) -> Coder:
        """Iterative quantisation: the principal axes are turned until signs fit the data best.

        With few axes several turns from different starts make a code of about ``BITS`` bits. The
        radius covers all but ``MISSED`` of the ``k`` nearest neighbours within the sample;
        among more vectors neighbours are nearer and differ in fewer bits.
        """
        mean = vectors.mean(axis=0)
        _, axes = np.linalg.eigh((vectors - mean).T @ (vectors - mean))
        axes = axes[:, ::-1][:, :BITS]
        along, draw, turns = (vectors - mean) @ axes, np.random.default_rng(0), []
        for _ in range(max(1, BITS // axes.shape[1])):
            turn = np.linalg.qr(draw.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(STEPS):
                left, _, right = np.linalg.svd(along.T @ np.where(along @ turn >= 0, 1.0, -1.0))
                turn = left @ right
            turns.append(axes @ turn)
        coder = cls(mean, np.concatenate(turns, axis=1), 0)
        codes, asked = coder.codes(vectors), vectors[:PROBES]
        squares = (vectors * vectors).sum(axis=1)
        apart = squares[: len(asked), None] + squares[None, :] - 2 * asked @ vectors.T
        np.fill_diagonal(apart, np.inf)
        count = min(k, len(vectors) - 1)
        if count < 1:
            return cls(mean, coder.rotations, 8 * codes.shape[1])
        near = np.argpartition(apart, count - 1, axis=1)[:, :count]
        bits = np.take_along_axis(hamming(codes[: len(asked)], codes), near, axis=1)
        return cls(mean, coder.rotations, int(np.quantile(bits, 1 - MISSED, method="higher")))


class MultiIndex:
    """The codes of a block by each of their substrings: sorted values, and the codes behind them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for values in np.ascontiguousarray(codes).view("<u2").T:
            order = np.argsort(values, kind="stable")
            distinct, start = np.unique(values[order], return_index=True)
            self.tables.append((distinct, np.repeat(np.arange(len(distinct)), np.diff(np.r_[start, len(order)])), order))

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Every pair (query, code) that differs in at most ``radius`` bits.

        With ``radius = m * s + a`` over ``m`` substrings, a code in reach differs in at most ``s``
        bits in one of the first ``a + 1``, or in at most ``s - 1`` in one of the others. Those
        buckets are probed, and what they hold is held against the whole code.
        """
        if radius >= 8 * self.codes.shape[1]:
            return tuple(x.ravel() for x in np.indices((len(asked), len(self.codes))))
        step, more = divmod(radius, len(self.tables))
        found = np.zeros((len(asked), len(self.codes)), bool)
        for i, (own, (values, bucket, order)) in enumerate(zip(np.ascontiguousarray(asked).view("<u2").T, self.tables)):
            reach = step if i <= more else step - 1
            if reach >= 0:
                hit = np.bitwise_count(own[:, None] ^ values[None, :]) <= reach
                if hit.any():
                    found[:, order] |= hit[:, bucket]
        x, y = np.nonzero(found)
        words = [np.ascontiguousarray(c).view("<u8") for c in (asked, self.codes)]
        bits = np.zeros(len(x), np.int32)
        for word in range(words[0].shape[1]):
            bits += np.bitwise_count(words[0][x, word] ^ words[1][y, word])
        return x[bits <= radius], y[bits <= radius]


def _named(rows: DataFrame) -> DataFrame:
    """``(key, node, dim, vector)`` of the rows that take part; ``node`` names the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, nodes, dims, vectors = [], [], [], []
            for place, vector in enumerate(batch.column(1)):
                values = vector.values if vector.is_valid else None
                if values is None or not len(values) or values.null_count:
                    continue
                own = values.to_numpy().astype("<f8") + 0.0  # no negative zero
                if np.isfinite(own).all() and own.any():
                    data = own.tobytes()
                    taken.append(place)
                    nodes.append(xxh3_128_digest(data))
                    dims.append(len(own))
                    vectors.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(taken, pa.int64())), pa.array(nodes, pa.binary()), pa.array(dims, pa.int32()),
                 pa.array(vectors, pa.binary())],
                ["key", "node", "dim", "vector"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, node binary, dim int, vector binary")


def fit(classes: DataFrame, k: int = K, sample: int = SAMPLE) -> dict[int, Coder]:
    """A coder for each length of vectors in a bounded sample of ``classes (node, dim, vector)``."""
    drawn = classes.orderBy(F.xxhash64("node"), "node").limit(sample).select("dim", "vector").collect()
    groups: dict[int, list[bytes]] = {}
    for row in drawn:
        groups.setdefault(row.dim, []).append(bytes(row.vector))
    return {dim: Coder.fitted(np.frombuffer(b"".join(own), "<f8").reshape(-1, dim), k) for dim, own in groups.items()}


def coded(classes: DataFrame, coders: dict[int, Coder], radius: int | None = None) -> DataFrame:
    """Adds code and radius, the learned one if none is given.

    Vectors of a length that the sample lacks have one code, and every radius reaches it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            vectors = batch.column("vector").to_pylist()
            codes, radii = [bytes(8)] * len(dims), np.full(len(dims), 64, np.int32)
            for dim in np.unique(dims).tolist():
                if dim in coders:
                    places = np.flatnonzero(dims == dim)
                    own = np.frombuffer(b"".join(vectors[i] for i in places), "<f8").reshape(-1, dim)
                    for i, code in zip(places.tolist(), coders[dim].codes(own)):
                        codes[i] = code.tobytes()
                    radii[places] = coders[dim].radius if radius is None else radius
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(radii)], [*batch.schema.names, "code", "radius"]
            )

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in classes.schema)
    return classes.mapInArrow(run, f"{kinds}, code binary, radius int")


def blocks(codes: DataFrame, size: int) -> DataFrame:
    """``(dim, block, n, radius, ones, zeros, nodes, leasts, codes, vectors)``: codes in order, ``size`` to a row.

    ``ones`` and ``zeros`` have the bits that all codes of the block share.
    """
    numbered = ranked(codes.withColumn("grp", F.col("dim").cast("string")), "code, node", "rank", group="grp")
    packed = numbered.groupBy("dim", F.expr(f"(rank - 1) div {size}").alias("block")).agg(
        F.first("radius").alias("radius"), F.collect_list(F.struct("node", "least", "code", "vector")).alias("members")
    )
    kind = codes.schema["least"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                members = batch.column("members")[place].values
                parts = {name: members.field(name).to_pylist() for name in ("node", "code", "vector")}
                bits = np.frombuffer(b"".join(parts["code"]), np.uint8).reshape(len(members), -1)
                shared = [np.bitwise_and.reduce(x, axis=0).view("<i8").tolist() for x in (bits, ~bits)]
                columns = [[len(members)], *([x] for x in shared), *([b"".join(parts[name])] for name in ("node", "code", "vector"))]
                leasts = pa.ListArray.from_arrays(pa.array([0, len(members)], pa.int32()), members.field("least"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).slice(place, 1) for name in ("dim", "block", "radius")), leasts, *map(pa.array, columns)],
                    ["dim", "block", "radius", "leasts", "n", "ones", "zeros", "nodes", "codes", "vectors"],
                )

    return packed.mapInArrow(
        run,
        f"dim int, block long, radius int, leasts array<{kind}>, n long, ones array<long>, zeros array<long>, "
        "nodes binary, codes binary, vectors binary",
    )


def _bound() -> Column:
    """Bits in which every code of the one block differs from every code of the other."""
    apart = F.zip_with("a_ones", "zeros", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    also = F.zip_with("a_zeros", "ones", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    return F.aggregate(F.concat(apart, also), F.lit(0), lambda total, n: total + n)


def searched(index: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """``(asked, node, least, distance)``: the ``count`` nearest within its radius, for every vector of ``asked``.

    Pairs of blocks whose shared bits already differ in more than the radius are dropped before
    codes or vectors move; those of a pair that is left are searched together in one task.
    """
    sizes = index.groupBy("dim").agg(F.count("*").alias("n_blocks"))
    queries = asked.select(
        "dim", F.col("block").alias("a_block"), F.col("radius").alias("reach"), F.col("ones").alias("a_ones"), F.col("zeros").alias("a_zeros")
    )
    pairs = (
        queries.join(sizes, "dim")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
        .join(index.select("dim", "block", "ones", "zeros"), ["dim", "block"])
        .where(_bound() <= F.col("reach"))
        .select("dim", "block", "a_block", "reach")
    )
    own = asked.select("dim", F.col("block").alias("a_block"), *[F.col(name).alias(f"a_{name}") for name in ("nodes", "codes", "vectors")])
    joined = pairs.join(own, ["dim", "a_block"]).join(index.drop("radius", "ones", "zeros", "n"), ["dim", "block"])
    kind = index.schema["leasts"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = {name: batch.column(name)[place] for name in batch.schema.names}
                leasts = row["leasts"].values
                order = np.empty(len(leasts), np.int64)  # places of the keys in order, null first
                order[pc.sort_indices(leasts, null_placement="at_start").to_numpy()] = np.arange(len(leasts))
                read = lambda name, n, kind: np.frombuffer(row[name].as_buffer(), kind).reshape(n, -1)
                a_nodes, nodes = (np.frombuffer(row[name].as_buffer(), "V16") for name in ("a_nodes", "nodes"))
                a, b = (read(name, len(x), "<f8") for name, x in (("a_vectors", a_nodes), ("vectors", nodes)))
                own = read("a_codes", len(a), np.uint8)
                multi, reach = MultiIndex(read("codes", len(b), np.uint8)), row["reach"].as_py()
                for start in range(0, len(a), max(1, PAIRS // len(b))):
                    part = slice(start, start + max(1, PAIRS // len(b)))
                    x, y = multi.within(own[part], reach)
                    apart = distances(a[part][x], b[y])
                    best = np.lexsort((order[y], apart, x))
                    x, y, apart = x[best], y[best], apart[best]
                    first = np.searchsorted(x, x)
                    kept = np.arange(len(x)) - first < count
                    x, y, apart = x[kept], y[kept], apart[kept]
                    if len(x):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a_nodes[part][x].tolist(), pa.binary()), pa.array(nodes[y].tolist(), pa.binary()),
                             leasts.take(pa.array(y)), pa.array(apart)],
                            ["asked", "node", "least", "distance"],
                        )

    found = joined.mapInArrow(run, f"asked binary, node binary, least {kind}, distance double")
    nearest = W.partitionBy("asked").orderBy("distance", F.col("least").asc_nulls_first(), "node")
    return found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= count).drop("place")


def nearest(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K,
    sample: int = SAMPLE, block: int = BLOCK, radius: int | None = None,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the ``k`` nearest found of each row whose key ``every`` divides.

    Null or empty vectors, zero ones and those with null or non-finite components take no part.
    Vectors of different length have no distance. A row is no neighbour of itself, but a copy of it
    is, also one with the same key; a repeated query gives its rows again. Rows without a key are
    found, ahead of others at the same distance, but ask nothing.

    Every distinct vector is indexed once. Rotations and radius come from at most ``sample`` of them.
    A query finds all vectors whose codes lie within ``radius`` bits (by default as many as cover the
    sample's own neighbours); the true distances rank them. One
    that finds fewer than ``k`` rows although there are more is searched again without a radius.
    """
    share_code(rows.sparkSession)
    chosen = rows.select(column(rows, key).alias("key"), column(rows, vector).cast("array<double>").alias("vector"))
    own = materialized(_named(chosen), "vectors")
    asks = F.coalesce(F.col("key") % every == 0, F.lit(False))
    classes = materialized(
        own.groupBy("node").agg(
            F.first("dim").alias("dim"), F.first("vector").alias("vector"), F.min("key").alias("least"), F.bool_or(asks).alias("asks"),
            F.bool_or(F.col("key").isNull()).alias("nameless"),
        ).select("node", "dim", "vector", F.when(~F.col("nameless"), F.col("least")).alias("least"), "asks"),
        "classes",
    )
    codes = materialized(coded(classes, fit(classes, k, sample), radius), "codes")
    index = materialized(blocks(codes.drop("asks"), block), "index")
    queries = codes.where("asks").drop("asks")
    keys = W.partitionBy("node").orderBy(F.col("key").asc_nulls_first())
    first = own.select("key", "node").withColumn("place", F.row_number().over(keys)).where(F.col("place") <= k + 1)
    first = materialized(first.select("node", "key"), "keys")

    def lists(asked: DataFrame) -> DataFrame:
        """The ``k + 1`` nearest rows of each vector that asks, itself among them."""
        found = searched(index, materialized(blocks(asked, ASKED), "asked"), k + 1).join(first, "node")
        near = F.sort_array(F.collect_list(F.struct("distance", "key")))
        return found.groupBy("asked").agg(F.slice(near, 1, k + 1).alias("near"))

    found = materialized(lists(queries), "near")
    totals = own.groupBy("dim").agg(F.count("*").alias("total"))
    few = queries.join(found.select(F.col("asked").alias("node"), F.size("near").alias("n")), "node", "left").join(totals, "dim")
    few = materialized(few.where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), "total")).select(*queries.columns), "few")
    if not few.isEmpty():
        whole = materialized(lists(few.withColumn("radius", (F.length("code") * 8).cast("int"))), "near")
        found = found.join(few.select(F.col("node").alias("asked")), "asked", "left_anti").union(whole)
        found = materialized(found, "near")
    asking = own.where(asks).select(F.col("key").alias("query_id"), F.col("node").alias("asked"))
    same = F.transform("near", lambda row: (row["distance"] == 0) & row["key"].eqNullSafe(F.col("query_id")))
    others = asking.join(found, "asked").withColumn("own", F.array_position(same, True) - 1)
    others = others.select("query_id", F.slice(F.filter("near", lambda row, i: i != F.col("own")), 1, k).alias("near"))
    ranks = others.select("query_id", F.posexplode("near").alias("place", "found"))
    return ranks.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("found.key").alias(key), F.col("found.distance").alias("score")
    )
