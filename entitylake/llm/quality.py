"""Quality rules: plain counts per document, and a hashed n-gram likelihood ratio with a threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from entitylake.llm.batches import blocks_of_words, column, share_code, slices, texts

BITS = 16
GRAM = 4
TRUSTED = 20_000
# Nats per n-gram; clean texts, also of a language the labels hardly cover, lie well above.
THRESHOLD = -0.5
SMOOTHING = 0.5
SYMBOLS = b"#*$%&|<>"
RUN = 5
MIN_WORDS = 10
MOST_REPEATED = 20

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def buckets(text: bytes, bits: int = BITS, gram: int = GRAM, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """The hash buckets of all runs of ``gram`` bytes, block by block."""
    for start in range(0, max(len(text) - gram + 1, 0), block):
        data = np.frombuffer(text[start : start + block + gram - 1], np.uint8).astype(np.uint32)
        n = len(data) - gram + 1
        found = np.zeros(n, np.uint32)
        for i in range(gram):
            found = found * np.uint32(0x01000193) + data[i : n + i] * np.uint32(0x9E3779B1)
        found ^= found >> np.uint32(15)
        found *= np.uint32(0x85EBCA6B)
        yield found >> np.uint32(32 - bits)


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """How many words lie in runs of ``run`` words that occur twice or more; runs are compared by hash."""
    n = len(words) - run + 1
    if n < 2:
        return 0
    own = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    hashes = np.zeros(n, np.uint64)
    for i in range(run):
        hashes = (hashes ^ own[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(run):
        covered[i : n + i] |= again
    return int(covered.sum())


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The base counts of one text, in the order of ``BASE``."""
    words = [word for block in blocks_of_words(text) for word in block]
    seen: set[bytes] = set()
    repeats = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                repeats += 1
            elif line.strip():
                seen.add(line)
    return (
        len(words),
        sum(map(len, words)) - len(text.translate(None, bytes([*range(128), *range(192, 256)]))),
        sum(text.count(symbol) for symbol in SYMBOLS),
        repeats,
        repeated_words(words),
    )


def likelihood_ratios(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
    most: int = TRUSTED, bits: int = BITS, gram: int = GRAM,
) -> np.ndarray:
    """For each of ``2 ** bits`` buckets: the log of its share in trusted texts over its share in all.

    All documents count towards the corpus. The trusted texts are whole texts of at most ``most``
    documents whose keys ``trusted`` holds in its first column, those with the least hashes; both of a
    ratio's counts, the trusted one and the one expected from the corpus, are raised by
    ``SMOOTHING``. Without any trusted text, all ratios are 0. A task sends one row per bucket that it has met, and the driver gets one
    row per bucket.
    """
    share_code(docs.sparkSession)
    ids = trusted.select(F.col(trusted.columns[0]).alias("id")).dropna().distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(most).withColumn("target", F.lit(True))
    own = docs.select(column(docs, key).alias("id"), column(docs, text).cast("string").alias("text"))
    flagged = own.join(F.broadcast(ids), "id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for own, target in zip(texts(part, "text"), part.column("target").to_pylist()):
                    for places in buckets(own, bits, gram):
                        if len(places) > 1 << bits:
                            n = np.bincount(places, minlength=1 << bits)
                            found[0] += n
                            found[1] += n * target
                        else:
                            np.add.at(found[0], places, 1)
                            if target:
                                np.add.at(found[1], places, 1)
        used = np.flatnonzero(found[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[0, used]), pa.array(found[1, used])], ["bucket", "n", "n_target"])

    met = flagged.mapInArrow(run, "bucket long, n long, n_target long")
    both = np.zeros((2, 1 << bits))
    for row in met.groupBy("bucket").agg(F.sum("n"), F.sum("n_target")).collect():
        both[:, row[0]] = row[1:]
    if not both[1].any():
        return np.zeros(1 << bits, np.float32)
    expected = both[0] * both[1].sum() / both[0].sum()
    return np.log((both[1] + SMOOTHING) / (expected + SMOOTHING)).astype(np.float32)


def judged(
    docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = THRESHOLD, gram: int = GRAM
) -> DataFrame:
    """``(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept)``.

    ``row`` is a struct of all columns of ``docs``. ``score`` is the mean ratio of the text's n-grams,
    0 for a text too short to have one. A document is kept if it has ``MIN_WORDS`` words, at most
    ``MOST_REPEATED`` percent of them in repeated runs, and a score of ``threshold`` or more. A null
    text counts as empty.
    """
    share_code(docs.sparkSession)
    bits = len(ratios).bit_length() - 1

    def measure(values: pd.Series) -> pd.DataFrame:
        rows = []
        for value in values:
            data = (value or "").encode()
            total = sum(float(ratios[places].sum(dtype=np.float64)) for places in buckets(data, bits, gram))
            rows.append((*counts(data), total / max(len(data) - gram + 1, 1)))
        return pd.DataFrame(rows, columns=[*(part.split()[0] for part in BASE.split(", ")), "score"])

    found = F.pandas_udf(measure, BASE + ", score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    own = docs.select(
        F.struct(*(column(docs, name) for name in docs.columns)).alias("row"), column(docs, text).cast("string").alias("text")
    )
    return (
        own.select("row", found("text").alias("found"))
        .select("row", "found.*")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )


def good_only(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", **limits: float) -> DataFrame:
    """The documents that ``judged`` keeps, with the columns of ``docs``."""
    return judged(docs, likelihood_ratios(docs, trusted, key, text), text, **limits).where("kept").select("row.*")
