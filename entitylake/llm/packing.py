"""Best-fit decreasing packing of token sequences."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from entitylake.llm.batches import column, share_code, slices
from entitylake.llm.tokens import encoder
from entitylake.session import materialized

CAPACITY = 2048
END = 0


class Capacities:
    """A segment tree over remaining capacities: how many bins are open at each."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += bins
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open bin that holds ``length``, in logarithmic time."""
        node = length + self.leaves
        while not self.open[node]:
            while node & 1:  # up from right children, then over to the right
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where best-fit decreasing puts ``counts[length]`` pieces of each length.

    Pieces of one length are alike, and so are open bins with the same room, so both are
    handled in runs: ``(length, rank, n, bin, offset)`` puts the ``n`` pieces from ``rank`` on,
    among those of that length, into the ``n`` bins from ``bin`` on, at ``offset``. This is the
    packing that takes the pieces one by one, longest first, each into the fullest bin that has
    room; its cost depends on ``capacity`` only, not on the number of pieces.
    """
    runs, bins, tree = [], 0, Capacities(capacity)
    waiting: defaultdict[int, deque[tuple[int, int]]] = defaultdict(deque)
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, n = bins, -(-left // each)
                bins += n
            else:
                each = room // length
                first, n = waiting[room].popleft()
                tree.add(room, -n)
            # a bin is filled before the next one gets a piece of this length
            full = min(n, left // each)
            for i in range(each if full else 0):
                runs.append((length, rank, full, first, capacity - room + i * length))
                rank += full
            left -= full * each
            rest = [(first, full, room - each * length)]
            first, n = first + full, n - full
            if n and left:
                part = left
                for i in range(part):
                    runs.append((length, rank, 1, first, capacity - room + i * length))
                    rank += 1
                left = 0
                rest.append((first, 1, room - part * length))
                first, n = first + 1, n - 1
            rest.append((first, n, room))
            for start, some, space in rest:
                if some and space:
                    waiting[space].append((start, some))
                    tree.add(space, some)
    return runs


def pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """Token pieces of every document: ``(key, piece, start, length, ids_crc32, part, rank[, ids])``.

    A document is its ids and ``end``. A longer one than ``capacity`` is cut so that all pieces
    but the first are full. ``rank`` numbers a task's (``part``'s) pieces of one length.
    """
    share_code(docs.sparkSession)
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part_id = encoder(tokenizer), Counter(), TaskContext.get().partitionId()
        stop = np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                places, rows = [], []
                for place, value in enumerate(part.column("text").to_pylist()):
                    ids = encode(value or "") + stop
                    total = len(ids) // 4
                    first = total % capacity or capacity
                    starts = [0, *range(first, total, capacity)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], total])):
                        own = ids[4 * a : 4 * b]
                        places.append(place)
                        row = (i, a, b - a, zlib.crc32(own), part_id, seen[b - a])
                        rows.append((*row, np.frombuffer(own, "<u4").tolist()) if with_ids else row)
                        seen[b - a] += 1
                columns = [pa.array(values) for values in zip(*rows)]
                columns[0] = columns[0].cast(pa.int32())
                columns[4] = columns[4].cast(pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(places)), *columns], names)

    chosen = docs.select(column(docs, key).alias("key"), column(docs, text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return chosen.mapInArrow(run, schema + ", ids array<long>" * with_ids)


def packed(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """``pieces`` with the ``sequence_id`` and ``offset`` of each; every sequence is gapless from 0.

    All pieces are packed together: the packing needs only how many there are of each length,
    at most ``capacity`` numbers. A null or empty text is one piece of length 1. Repeated rows
    are packed each on its own. Which of several equally long pieces goes where depends on the
    order of the input.
    """
    cut = materialized(pieces(docs, tokenizer, key, text, capacity, end, with_ids), "pieces")
    own = materialized(cut.groupBy("length", "part").count(), "lengths")
    # at most ``capacity`` rows
    counts = {row[0]: row[1] for row in own.groupBy("length").agg(F.sum("count")).collect()}
    runs = np.array(best_fit(counts, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    ranked = cut.join(own.select("length", "part", before.alias("before")), ["length", "part"])
    names = ["key", "piece", "start", "length", "ids_crc32"]
    rest = ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            found = runs[np.searchsorted(starts, (length << 44) + rank, side="right") - 1]
            place = [pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), *place, *(batch.column(name) for name in rest)],
                [*names, "sequence_id", "offset", *rest],
            )

    chosen = ranked.select(*names, (F.col("rank") + F.col("before")).alias("rank"), *rest)
    kind = cut.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return chosen.mapInArrow(run, schema + ", ids array<long>" * with_ids).withColumnRenamed("key", key)
