"""Language identification by interpolated Kneser-Ney models over characters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from entitylake.llm.batches import column, share_code, slices
from entitylake.session import materialized

ORDER = 4
SAMPLE = 500
CALIBRATION = 5
REJECTED = 6.0
SHARPNESS = 20.0
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, with one space (32) for each run of anything else.

    Empty if the text has no letter; otherwise spaces stand before it, for a full first context,
    and after it.
    """
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    plain = _letters[0][points]
    if not plain.any():
        return np.zeros(0, np.uint32)
    points = np.where(plain, points, 32).astype(np.uint32)
    kept = points[plain | np.r_[False, plain[:-1]]]
    return np.concatenate([np.full(ORDER - 1, 32, np.uint32), kept, np.full(int(kept[-1] != 32), 32, np.uint32)])


def hashed(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each row of code points; the hash of no code points is that of 0."""
    found = np.full(len(points), points.shape[1], np.uint64)
    for i in range(points.shape[1]):
        found = (found ^ points[:, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    return found


@dataclass
class Level:
    """One order of one language: discounted shares by n-gram, and the weight of the lower order by context."""

    grams: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), otherwise)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], otherwise)


class Language:
    """An interpolated Kneser-Ney model, in sorted hash arrays.

    The highest order counts occurrences, lower orders count the different letters that an
    n-gram was seen after. The discount of an order is ``n1 / (n1 + 2 n2)``.
    """

    def __init__(self, points: np.ndarray, counts: np.ndarray) -> None:
        self.levels: list[Level] = []
        while points.shape[1]:
            grams, contexts = hashed(points), hashed(points[:, :-1])
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            known, place = np.unique(contexts, return_inverse=True)
            total = np.bincount(place, counts)
            share = np.maximum(counts - discount, 0) / total[place]
            order = np.argsort(grams)
            followers = np.minimum(np.bincount(place, np.minimum(counts, discount)), total)
            self.levels.insert(0, Level(grams[order], share[order], known, followers / total))
            points = points[:, 1:]
            _, first, counts = np.unique(hashed(points), return_index=True, return_counts=True)
            points = points[first]

    def probability(self, points: np.ndarray, letters: int) -> np.ndarray:
        """Of the last code point of each row after the ones before it."""
        found = np.full(len(points), 1 / letters)
        for n, level in enumerate(self.levels, 1):
            own = points[:, points.shape[1] - n :]
            weight = _at(level.contexts, level.weight, hashed(own[:, :-1]), 1.0)
            found = _at(level.grams, level.share, hashed(own), 0.0) + weight * found
        return found


class Model:
    """The languages' models, and one table of log-probabilities for all n-grams of the highest order."""

    def __init__(self, names: list[str], points: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.names = names
        self.languages = [Language(p, c) for p, c in zip(points, counts)]
        every = np.concatenate(points) if points else np.zeros((0, ORDER), np.uint32)
        self.letters = len(np.unique(every)) + 1
        self.grams, first = np.unique(hashed(every), return_index=True)
        self.table = self.logs(every[first]).astype(np.float32)
        # where in the table the hashes with given first bits begin
        self.bits = max(len(self.grams).bit_length() + 1, 1)
        heads = np.arange((1 << self.bits) + 1, dtype=np.float64) * 2.0 ** (64 - self.bits)
        self.index = np.searchsorted(self.grams, heads[:-1].astype(np.uint64)).astype(np.int32)
        self.limits = np.full(len(names), np.inf)

    def logs(self, points: np.ndarray) -> np.ndarray:
        found = [np.log(one.probability(points, self.letters)) for one in self.languages]
        return np.stack(found, axis=1) if found else np.zeros((len(points), 0))

    def scores(self, points: np.ndarray) -> np.ndarray:
        """Log-probabilities per language of every position that has a full context."""
        views = np.lib.stride_tricks.sliding_window_view(points, ORDER)
        wanted = hashed(views)
        place = self.index[(wanted >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.int64)
        last = len(self.grams) - 1
        place = np.minimum(place, last)
        behind = np.flatnonzero(self.grams[place] < wanted)
        while len(behind):
            place[behind] += 1
            behind = behind[place[behind] <= last]
            behind = behind[self.grams[place[behind]] < wanted[behind]]
        place = np.minimum(place, last)
        found = self.table[place]
        new = np.flatnonzero(self.grams[place] != wanted)
        if len(new):
            _, first, back = np.unique(wanted[new], return_index=True, return_inverse=True)
            found[new] = self.logs(views[new[first]])[back]
        return found

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per letter for each text and language, and the number of letters."""
        rows = [letters(text) for text in texts]
        found = np.zeros((len(rows), len(self.names)))
        n = np.array([max(len(row) - ORDER + 1, 0) for row in rows], np.int64)
        used = [i for i in range(len(rows)) if n[i]]
        if used and self.names:
            logs = self.scores(np.concatenate([rows[i] for i in used]))
            starts = np.cumsum([0] + [len(rows[i]) for i in used[:-1]])
            for i, start in zip(used, starts):
                found[i] = -logs[start : start + n[i]].sum(axis=0, dtype=np.float64) / n[i]
        return found, n


def held_out(key: Column) -> Column:
    """A quarter of the documents, by a hash of their key, that training never sees."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _grams(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: how often each run of ``ORDER`` letters occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found: Counter[tuple[str, str]] = Counter()
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    own = letters(text).tobytes().decode("utf-32-le")
                    found.update((lang, own[i : i + ORDER]) for i in range(len(own) - ORDER + 1))
                if found:
                    columns = [[k[0] for k in found], [k[1] for k in found], list(found.values())]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )


def fitted(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE
) -> Model:
    """Models of all languages that the documents outside ``held_out`` are labelled with.

    The fit is on a bounded sample: of each language the ``sample`` labelled documents, whole,
    with the least hashes of key and text; equal rows count once. One in ``CALIBRATION`` of them
    is not trained on but sets the limit above which a cross-entropy is rejected, ``REJECTED``
    standard deviations above their mean. Models hold all n-grams of these documents; the driver
    and a broadcast hold no more either.
    """
    share_code(docs.sparkSession)
    own = docs.select(
        column(docs, key).alias("key"), column(docs, text).cast("string").alias("text"), column(docs, lang).cast("string").alias("lang")
    ).where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("key")))
    own = own.select("text", "lang", F.xxhash64("key", "text").alias("drawn"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("drawn"))
    ranked = own.select("lang", "drawn").distinct().withColumn("place", place).where(F.col("place") <= sample)
    # at most ``sample`` rows per language
    chosen = F.broadcast(ranked.withColumnRenamed("lang", "l").withColumnRenamed("drawn", "d"))
    sampled = own.join(chosen, (F.col("drawn") == F.col("d")) & (F.col("lang") == F.col("l")))
    sampled = materialized(sampled.groupBy("lang", "place").agg(F.first("text").alias("text")), "sample")
    apart = F.col("place") % CALIBRATION == 0
    kept = _grams(sampled.where(~apart)).toPandas().sort_values(["lang", "gram"])
    names, points, numbers = [], [], []
    for name, group in sorted(kept.groupby("lang"), key=lambda g: g[0]):
        names.append(name)
        points.append(np.frombuffer("".join(group["gram"]).encode("utf-32-le"), "<u4").reshape(-1, ORDER))
        numbers.append(group["n"].to_numpy())
    model = Model(names, points, numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                langs = part.column("lang").to_pylist()
                found, n = model.entropies(part.column("text").to_pylist())
                own = [(lang, found[i, names.index(lang)]) for i, lang in enumerate(langs) if n[i] and lang in names]
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*own)], ["lang", "entropy"])

    spread = sampled.where(apart).select("text", "lang").mapInArrow(run, "lang string, entropy double")
    for row in spread.groupBy("lang").agg(F.avg("entropy"), F.stddev_pop("entropy"), F.count("*")).collect():
        if row[3] > 1:
            model.limits[names.index(row[0])] = row[1] + REJECTED * row[2]
    return model


def identified(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score, cross_entropy, rejected)`` for every whole text.

    ``lang_pred`` has the lowest cross-entropy per letter, of equals the first by name; it is
    ``und`` with score 0 if the text is null or has no letter, or no language was learned.
    ``score`` compares the languages as though twenty letters had been seen. ``rejected`` says
    that even the best cross-entropy lies above what calibration found for that language.
    """
    share_code(docs.sparkSession)
    limit = max(1 << 16, (8 << 20) // max(len(model.names), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.names, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, "text", limit):
                found, n = model.entropies([value or "" for value in part.column("text").to_pylist()])
                known = (n > 0) & bool(model.names)
                best = found.argmin(axis=1) if model.names else np.zeros(len(n), np.int64)
                least = found[np.arange(len(n)), best] if model.names else np.zeros(len(n))
                score = 1 / np.exp((least[:, None] - found) * SHARPNESS).sum(axis=1) if model.names else np.zeros(len(n))
                limits = model.limits[best] if model.names else least
                columns = [
                    pa.array(names[np.where(known, best, len(names) - 1)].tolist(), pa.string()),
                    pa.array(np.where(known, score, 0.0)),
                    pa.array(least, mask=~known),
                    pa.array(known & (least > limits)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), *columns], ["key", "lang_pred", "score", "cross_entropy", "rejected"]
                )

    chosen = docs.select(column(docs, key).alias("key"), column(docs, text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)
