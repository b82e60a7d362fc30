"""SimHash near-duplicates: exact comparison of fingerprints, tile by tile."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from xxhash import xxh64_intdigest

from entitylake.llm.batches import blocks_of_words, column, share_code, slices, texts
from entitylake.llm.links import components
from entitylake.session import materialized

SHINGLE = 3
SEED = 42
RADIUS = 2
TILE = 2048


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the hashes of the text's word shingles.

    A-Z are taken as a-z. A text with fewer words than a shingle has one shingle, all its
    words; a text without words has fingerprint 0.
    """
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in blocks_of_words(text.lower()):
        words = tail + words
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        for start in range(0, len(hashes), 65_536):
            part = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        tail = words[max(len(words) - size + 1, 0) :]
    if not total:
        return xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def _digest(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.md5(column(docs, text).cast("string")), F.lit(""))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, digest, fp)`` per row: a digest of the text, and the 64 bits as a signed long; a null text counts as empty."""
    share_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([fingerprint(t) for t in texts(part, "text")], np.uint64)
                columns = [part.column("key"), part.column("digest"), pa.array(found.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "digest", "fp"])

    chosen = docs.select(
        column(docs, key).alias("key"), _digest(docs, text).alias("digest"), column(docs, text).cast("string").alias("text")
    )
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, digest string, fp long")


def _linked(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    rows = max(1, (1 << 20) // max(len(b), 1))
    near = [
        np.bitwise_count(a[i : i + rows, None] ^ b[None, :]) <= radius for i in range(0, len(a), rows)
    ]
    return np.concatenate(near) if near else np.zeros((0, len(b)), bool)


def tile_edges(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links between two tiles connect, one per fingerprint at most."""
    near = _linked(a, b, radius)
    rows, columns = near.any(axis=1), near.any(axis=0)
    near, a, b = near[rows][:, columns], a[rows], b[columns]
    if not len(a):
        return a, b
    # the least label spreads over the links until nothing changes; labels are places in a
    left, right = np.arange(len(a)), None
    while True:
        right = np.where(near, left[:, None], len(a)).min(axis=0)
        new = np.minimum(left, np.where(near, right[None, :], len(a)).min(axis=1))
        if (new == left).all():
            break
        left = new
    return np.concatenate([a, b]), np.concatenate([a[left], a[right]])


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints ``(fp)``, as few as connect what is linked.

    All fingerprints are laid out in tiles and tiles are compared whole, by exclusive-or and bit
    count. Tiles hold fingerprints of one population count, and two tiles are compared only if
    their counts differ by at most ``radius``. So that the work stays in proportion to the input,
    tiles are cut once for each of ``radius + 1`` parts of the bits and hold fingerprints that
    agree in the part's first bits; fingerprints within the radius agree in a whole part. The
    number of these bits follows from the number of fingerprints. Where more than ``tile``
    fingerprints share bits and count, they are dealt out to several tiles by a hash. The result
    holds for any of these sizes.
    """
    spark = prints.sparkSession
    share_code(spark)
    n = prints.count()
    parts = radius + 1
    width = 64 // parts
    bits = min(max(0, ceil(log2(max(n, 1) / (2 * tile)))), width)
    if not bits:
        parts = 1
    spread = prints.select(
        "fp",
        F.bit_count("fp").cast("int").alias("ones"),
        F.posexplode(
            F.array([F.expr(f"shiftrightunsigned(fp, {i * width}) & {(1 << bits) - 1}L") for i in range(parts)])
        ).alias("part", "agree"),
    )
    place = ["part", "agree", "ones"]
    counts = materialized(
        spread.groupBy(place).count().select(*place, F.ceil(F.col("count") / tile).cast("int").alias("n_tiles")),
        "tiles",
    )
    tiles = materialized(
        spread.join(counts, place)
        .groupBy(*place, F.expr("pmod(xxhash64(fp), n_tiles)").cast("int").alias("tile"))
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    step = F.explode(F.array([F.lit(i) for i in range(radius + 1)]))
    left = (
        tiles.select("part", "agree", F.col("ones").alias("own"), F.col("tile").alias("own_tile"),
                     F.col("fps").alias("a"), step.alias("step"))
        .withColumn("ones", F.col("own") + F.col("step"))
        .join(counts, place)
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
        .where((F.col("step") > 0) | (F.col("tile") >= F.col("own_tile")))
    )
    pairs = left.join(tiles, [*place, "tile"]).select("a", F.col("fps").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (batch.column(i)[row].values.to_numpy().view(np.uint64) for i in (0, 1))
                x, y = tile_edges(a, b, radius)
                x, y = x[x != y], y[x != y]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _labels(own: DataFrame, radius: int, tile: int) -> DataFrame:
    """``(fp, component_id, root)`` per fingerprint of ``own (key, fp)``; ``root`` names its component."""
    first = materialized(own.groupBy("fp").agg(F.min("key").alias("first")), "first")
    roots = materialized(components(links(first.select("fp"), radius, tile)), "roots")
    joined = first.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first")
    # written, so that adaptive execution can split large groups in the joins
    least = materialized(joined.groupBy("root").agg(F.min("first").alias("least")), "least")
    moved = joined.join(least, "root").select(F.col("fp").alias("moved"), "root", "least")
    labels = first.join(moved, F.col("fp") == F.col("moved"), "left").select(
        "fp", F.coalesce("least", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return materialized(labels, "labels")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """``(key, fingerprint, component_id)`` per row of ``docs``.

    Texts are linked if their fingerprints differ in at most ``radius`` bits; ``component_id`` is
    the smallest key that links reach, the row's own included. Texts that are null, empty or
    without words have fingerprint zero and are linked with each other. A null key is never a
    ``component_id``, unless no linked row has another. Repeated rows stay, each with its row.
    """
    own = materialized(fingerprints(docs, key, text), "fingerprints")
    return own.join(_labels(own, radius, tile), "fp").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest key stays.

    Of several rows of a group with that key one stays: that with the smallest fingerprint, then
    digest of its text, then the first by its other columns (but maps, which have no order). Rows of
    another group stay, whatever their key. Rows without a key cannot be told apart and all stay.
    """
    known = docs.where(column(docs, key).isNotNull())
    own = materialized(fingerprints(known, key, text), "fingerprints")
    least = own.join(_labels(own, radius, tile), "fp").where(F.col("key") == F.col("component_id"))
    one = least.groupBy("key", "root").agg(F.min(F.struct("fp", "digest")).alias("one")).select("key", "one.digest")
    whole = F.struct(*(column(known, name) for name in docs.columns)).alias("row")
    rows = known.select(whole, column(known, key).alias("key"), _digest(known, text).alias("digest"))
    ordered = [item.name for item in docs.schema.fields if not re.search("map<|variant|interval", item.dataType.simpleString())]
    order = W.partitionBy("key", "digest").orderBy(*(F.col("row")[name] for name in ordered if name != text), F.lit(0))
    kept = rows.join(one, ["key", "digest"], "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    found = kept.select(*(F.col("row")[name].alias(name) for name in docs.columns))
    return found.union(docs.where(column(docs, key).isNull()))
