"""Repeated passages: suffix trees over groups of suffixes that share a prefix.

A passage of ``window`` words repeats if the suffixes that start with it meet in an inner node
``window`` words deep. Only suffixes with equal first words can meet, so they are split by
prefix. The prefix that names a suffix's group reaches to the end of the lowest-hashed run of
``GRAM`` words in its first ``window`` words: between ``GRAM`` and ``window`` words, chosen by
content alone, so suffixes with equal windows always fall in one group. Neighbouring suffixes
mostly end their prefix at the same run of words; they travel as one segment of text, not one by
one. Groups with one member hold no repeat and are never sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from entitylake.llm.batches import blocks_of_words, column, share_code, slices, texts
from entitylake.session import materialized

WINDOW = 35
GRAM = 8
GROUP = 4096
ID = ["id1", "id2"]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of a text, in order: the first start of each segment, and its anchor's key.

    The anchor of a window is its run of ``gram`` words with the least hash, the first of several.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for i in range(gram):
        grams = _mixed(grams * np.uint64(3) + hashes[i : i + len(grams)])
    width = window - gram + 1
    found = np.empty(n, np.int64)
    for i in range(0, n, 1 << 16):
        part = grams[i : min(i + (1 << 16), n) + width - 1]
        views = np.lib.stride_tricks.sliding_window_view(part, width)
        found[i : i + len(views)] = views.argmin(axis=1) + np.arange(i, i + len(views))
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return first, grams[found[first]]


def _words(text: bytes) -> list[bytes]:
    return [word for block in blocks_of_words(text) for word in block]


def with_id(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id1, id2, text, row)``: a 128-bit name of the key and text, equal for equal rows."""
    own = column(docs, text).cast("string")
    both = [column(docs, key).cast("string"), own]
    return docs.select(
        F.xxhash64(*both).alias(ID[0]),
        F.xxhash64(F.lit(1), *both).alias(ID[1]),
        own.alias("text"),
        F.struct(*(column(docs, name) for name in docs.columns)).alias("row"),
    )


def _keys(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [
                    anchors(_hashes(_words(t)), window, gram)[1].view(np.int64) for t in texts(part, "text")
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.list_(pa.int64()))], [*ID, "keys"]
                )

    return rows.mapInArrow(run, "id1 long, id2 long, keys array<long>")


def _segments(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """A row for each chosen segment: its key, its place, its text."""
    names = [*ID, "key", "start", "digest", "segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = []
                chosen = part.column("chosen").to_pylist()
                ids = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                for (id1, id2), text, places in zip(ids, texts(part, "text"), chosen):
                    words = _words(text)
                    first, keys = anchors(_hashes(words), window, gram)
                    ends = np.r_[first[1:], max(len(words) - window + 1, 0)]
                    for place in sorted(places):
                        start, end = int(first[place]), int(ends[place])
                        segment = b" ".join(words[start : end + window - 1])
                        key = int(keys[place].view(np.int64))
                        rows.append((id1, id2, key, start, xxh3_128_digest(segment), segment))
                for i in range(0, len(rows), 10_000):
                    columns = [pa.array(values) for values in zip(*rows[i : i + 10_000])]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(
        run, "id1 long, id2 long, key long, start long, digest binary, segment binary"
    )


def _common(a: bytes, b: bytes) -> int:
    """How many first words are equal; every word ends with a space."""
    if b.startswith(a):
        return a.count(b" ")
    n = 0
    for x, y in zip(a.split(b" "), b.split(b" ")):
        if x != y:
            break
        n += 1
    return n


def inner_nodes(suffixes: list[bytes], window: int) -> list[tuple[int, int, int]]:
    """The inner nodes of the suffix tree at least ``window`` words deep: ``(depth, first, last)``.

    ``suffixes`` are the leaves in order, with a space after every word. The words that neighbours
    have in common are the depth of the node in which they meet; ``first`` to ``last`` are the
    leaves below a node, whose path from the root is a repeat that no word prolongs to the right.
    """
    nodes: list[tuple[int, int, int]] = []
    path: list[tuple[int, int]] = []  # the nodes from the root to the last leaf, with their first leaf
    for i in range(1, len(suffixes) + 1):
        depth = _common(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else 0
        first = i - 1
        while path and path[-1][0] > depth:
            ended, first = path.pop()
            nodes.append((ended, first, i - 1))
        if depth >= window and (not path or path[-1][0] < depth):
            path.append((depth, first))
    return nodes


def deep_leaves(segments: list[tuple[bytes, int]], window: int) -> list[list[int]]:
    """For each ``(segment, times)``: the starts of suffixes that are leaves below a deep node.

    A segment that occurs several times has as many leaves in place of one, below a node of their own.
    """
    leaves = []
    for place, (segment, times) in enumerate(segments):
        whole = segment + b" "
        words = segment.split(b" ")
        at = 0
        for start in range(len(words) - window + 1):
            leaves.append((whole[at:], place, start, times))
            at += len(words[start]) + 1
    leaves.sort()
    below = [0] * (len(leaves) + 1)
    for _, first, last in inner_nodes([leaf[0] for leaf in leaves], window):
        below[first] += 1
        below[last + 1] -= 1
    found: list[list[int]] = [[] for _ in segments]
    nodes = 0
    for i, (_, place, start, times) in enumerate(leaves):
        nodes += below[i]
        if times > 1 or nodes:
            found[place].append(start)
    return found


def runs(starts: list[int]) -> list[dict[str, int]]:
    """Ascending numbers as runs, first to last."""
    found: list[dict[str, int]] = []
    for start in starts:
        if found and start == found[-1]["last"] + 1:
            found[-1]["last"] = start
        else:
            found.append({"first": start, "last": start})
    return found


RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _by_tree(classes: DataFrame, window: int) -> DataFrame:
    """``(digest, runs)`` of repeated starts, key by key; one group is in memory at a time."""

    def table(rows: list[tuple[bytes, list[dict[str, int]]]]) -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], RUNS)]
        return pa.RecordBatch.from_arrays(columns, ["digest", "runs"])

    def done(group: list[tuple[bytes, bytes, int]]) -> Iterator[tuple[bytes, list[dict[str, int]]]]:
        found = deep_leaves([(segment, times) for _, segment, times in group], window)
        return ((digest, runs(sorted(starts))) for (digest, _, _), starts in zip(group, found) if starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, [], []
        for batch in batches:
            for own, digest, segment, times in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    out.extend(done(group))
                    key, group = own, []
                    if len(out) >= 10_000:
                        yield table(out)
                        out = []
                group.append((digest, segment, times))
        out.extend(done(group))
        if out:
            yield table(out)

    rows = classes.select("key", "digest", "segment", "times").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "digest binary, runs array<struct<first: long, last: long>>")


def _by_whole_prefix(classes: DataFrame, window: int) -> DataFrame:
    """``(digest, runs)`` for groups too large for memory: the prefix grows to the whole window.

    All suffixes of such a group agree that far, so that they meet in a node deep enough; no tree
    is built, as a count of its leaves, which combines on the map side, is enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digest, segment, times in zip(*(c.to_pylist() for c in batch.columns)):
                words = segment.split(b" ")
                for start in range(len(words) - window + 1):
                    prefix = xxh3_128_digest(b" ".join(words[start : start + window]))
                    rows.append((digest, start, times, prefix))
            for i in range(0, len(rows), 10_000):
                columns = [pa.array(values) for values in zip(*rows[i : i + 10_000])]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "start", "times", "prefix"])

    leaves = materialized(
        classes.select("digest", "segment", "times").mapInArrow(
            run, "digest binary, start long, times long, prefix binary"
        ),
        "leaves",
    )
    deep = leaves.groupBy("prefix").agg(F.sum("times").alias("total")).where("total > 1").select("prefix")
    one = F.struct(F.col("start").alias("first"), F.col("start").alias("last"))
    return leaves.join(deep, "prefix", "left_semi").groupBy("digest").agg(F.collect_list(one).alias("runs"))


def repeated_windows(
    rows: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP
) -> DataFrame:
    """``(id1, id2, runs)``: where windows start that start elsewhere too; ``rows (id1, id2, text)``."""
    gram = min(gram, window)
    keys = materialized(_keys(rows, window, gram), "keys")
    shared = keys.select(F.explode("keys").alias("key")).groupBy("key").count().where("count > 1")
    # written, so that adaptive execution can split a key with many rows in the join
    shared = materialized(shared.select("key"), "shared")
    chosen = (
        keys.select(*ID, F.posexplode("keys").alias("place", "key"))
        .join(shared, "key", "left_semi")
        .groupBy(ID)
        .agg(F.collect_set("place").alias("chosen"))
    )
    members = materialized(_segments(rows.join(chosen, ID), window, gram), "segments")
    classes = materialized(
        members.groupBy("key", "digest").agg(
            F.count("*").alias("times"), F.first("segment").alias("segment")
        ),
        "classes",
    )
    large = classes.groupBy("key").count().where(F.col("count") > group).select("key")
    large = materialized(large, "large")
    if large.isEmpty():
        found = _by_tree(classes, window)
    else:
        trees = _by_tree(classes.join(large, "key", "left_anti"), window)
        found = trees.union(_by_whole_prefix(classes.join(large, "key", "left_semi"), window))
    moved = "transform(runs, r -> struct(r.first + start AS first, r.last + start AS last))"
    return (
        members.select(*ID, "start", "digest")
        .join(found, "digest")
        .groupBy(ID)
        .agg(F.flatten(F.collect_set(F.expr(moved))).alias("runs"))  # equal rows have one name: each run once
    )


def _cut(text: pd.Series, runs: pd.Series, window: pd.Series) -> pd.DataFrame:
    rows = []
    for own, found, size in zip(text, runs, window):
        words = _words((own or "").encode())
        if found is None or not len(found):
            rows.append((len(words), 0, b" ".join(words).decode()))
            continue
        covered = np.zeros(len(words) + 1, np.int64)
        np.add.at(covered, [run["first"] for run in found], 1)
        np.add.at(covered, [run["last"] + int(size) for run in found], -1)
        gone = np.cumsum(covered[:-1]) > 0
        kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
        rows.append((len(words), int(gone.sum()), kept.decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **sizes: int
) -> DataFrame:
    """``(row, n_words, n_removed, kept)``; ``row`` is a struct of all columns of ``docs``.

    ``kept`` are the words, joined by one space, that no repeated window of ``window`` words
    covers. A window repeats if its words start anywhere else too, in another row or the same;
    windows are judged on the whole input. A null text has no words. Rows that repeat another
    row are elsewhere to each other. Texts shorter than the window are kept.
    """
    share_code(docs.sparkSession)
    named = with_id(docs, key, text)
    found = repeated_windows(named.select(*ID, "text"), window, **sizes)
    cut = F.pandas_udf(_cut, "n_words long, n_removed long, kept string")
    own = F.col("row")[text].cast("string")
    joined = named.drop("text").join(found, ID, "left").select("row", cut(own, "runs", F.lit(window)).alias("cut"))
    return joined.select("row", "cut.*")


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars", **sizes: int) -> DataFrame:
    """``docs`` with the repeats cut out of its texts, and ``n_chars`` as it is then, if there is one.

    Every row stays; a text without repeats stays as it is, with its own white space.
    """
    cut = without_repeats(docs, key, text, **sizes)
    rest = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row")[text].cast("string"))
    values = {text: rest, n_chars: F.length(rest).cast("long")}
    return cut.select(*(values.get(name, F.col("row")[name]).alias(name) for name in docs.columns))
