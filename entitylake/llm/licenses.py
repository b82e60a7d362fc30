"""License notices and texts by Dice coefficient over word bigrams, by built-in functions only."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from entitylake.llm.batches import column

THRESHOLD = 0.8

# Customary notices, by SPDX identifier.
NOTICES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Whole license texts and the standard headers of files, one a file, named by SPDX identifier.
TEXTS = tuple(
    (file.name.removesuffix(".txt").removesuffix(".header"), file.read_text(encoding="utf-8"))
    for file in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
)
# Windows of a text begin at every word pair, or at the SHARE-th part of the template if that is more.
SHARE = 128


def _pairs(notice: str) -> list[str]:
    words = re.findall("[a-z0-9]+", notice.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bigrams_of(notice: str) -> list[str]:
    return list(dict.fromkeys(_pairs(notice)))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """The numbers of bigrams between which a passage can reach the threshold with a template of ``size``."""
    low = next(n for n in range(size + 1) if 2 * n >= threshold * (n + size))
    high = size
    while 2 * size >= threshold * (high + 1 + size):
        high += 1
    return low, high


def _bigrams(words: Column) -> Column:
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))


def _templates(listed: tuple[tuple[str, str], ...], first: int, threshold: float) -> tuple[Column, list[str], int, int]:
    """The templates as one literal, all their bigrams, and the least and most bigrams of passages that fit one."""
    known = [(place, name, _pairs(text), bigrams_of(text)) for place, (name, text) in enumerate(listed, first)]
    known = [one for one in known if one[3]]
    limits = [bounds(len(own), threshold) for *_, own in known]
    structs = [
        F.struct(
            F.lit(name).alias("name"), F.lit(-place).alias("place"), F.split(F.lit("\n".join(own)), "\n").alias("bigrams"),
            F.lit(len(own)).alias("size"), F.lit(low).alias("low"), F.lit(high).alias("high"),
            F.lit(len(pairs)).alias("pairs"), F.lit(max(1, len(pairs) // SHARE)).alias("step"),
        )
        for (place, name, pairs, own), (low, high) in zip(known, limits)
    ]
    every = sorted({gram for *_, own in known for gram in own})
    return F.array(*structs), every, min(low for low, _ in limits), max(high for _, high in limits)


def _among(grams: list[str]) -> str:
    """SQL for being one of ``grams``: letters and digits, so nothing needs to be quoted in them."""
    return "IN (" + ", ".join(f"'{gram}'" for gram in grams) + ")"


def _score(grams: Column, t: Column) -> Column:
    """What counts of different ``grams`` held against a template: Dice coefficient and shared bigrams."""
    shared = F.transform(F.array(F.size(F.array_intersect(grams, t["bigrams"]))), lambda n: F.struct(
        (2.0 * n / (F.size(grams) + t["size"])).alias("dice"), n.alias("shared")
    ))
    return shared[0]


def _best_window(starts: Column, t: Column) -> Column:
    """The best of the windows of ``grams`` that begin at ``starts`` and are as long as the template."""

    def window(start: Column) -> Column:
        own = F.array(F.array_distinct(F.slice("grams", start + 1, t["pairs"])))
        return F.transform(own, lambda w: _score(w, t))[0]

    return F.array_max(F.transform(starts, window))


def _fitting(known: Column, templates: Column) -> Column:
    """The templates that a window can reach: it has no more bigrams of one than the whole text has."""
    enough = lambda t: (F.size(known) >= t["low"]) & (F.size(F.array_intersect(known, t["bigrams"])) >= t["low"])
    return F.filter(templates, enough)


def _found(score: Column, t: Column) -> Column:
    return F.transform(
        F.array(score),
        lambda s: F.struct(s["shared"].alias("shared"), s["dice"].alias("dice"), t["place"].alias("place"), t["name"].alias("name")),
    )[0]


def scanned(
    docs: DataFrame,
    text: str = "text",
    notices: tuple[tuple[str, str], ...] = NOTICES,
    threshold: float = THRESHOLD,
    texts: tuple[tuple[str, str], ...] = TEXTS,
) -> DataFrame:
    """``(row, license, dice, licenses)``; ``row`` is a struct of all columns of ``docs``.

    Texts are taken in lower case, as sequences of ASCII letters and digits, and compared by twice
    the number of different bigrams of the template that they have, over the bigrams of both.
    What is compared:

    * Passages with ``notices``: the whole text, its paragraphs (between blank lines) and its lines,
      if their size lets them reach the threshold.
    * Windows of the whole text, wherever lines break, with ``notices``: a window begins at a bigram
      of the notice and has as many bigrams as it, of which different ones count. So a notice is
      found inside a longer line.
    * Such windows with whole license texts and standard headers (``texts``); these begin at every
      word, or at every 128th part of a template that is longer than 255 bigrams.

    ``license`` is the one found with the most bigrams, of equals the one with the higher ``dice``,
    then the first in ``notices``, then ``texts``: a whole license text counts more than a sentence
    in it. ``licenses`` are all that reach the threshold, in order. Both are null and empty if there
    is none, or the text is null or empty.
    """
    row = F.struct(*(column(docs, name) for name in docs.columns)).alias("row")
    lower = F.lower(column(docs, text).cast("string"))
    own = docs.select(row, F.coalesce(lower, F.lit("")).alias("text"))
    word = F.lit("[a-z0-9]+")
    worded = own.select("row", "text", F.regexp_extract_all("text", word, F.lit(0)).alias("words"))
    none = F.array().cast("array<string>")
    cut = worded.select("row", "text", F.when(F.size("words") > 1, _bigrams(F.col("words"))).otherwise(none).alias("grams"))

    # one transform after the other: what a lambda takes has been computed once, an
    # expression that it repeats would be computed again each time
    parts = []
    if notices:
        sentences, every, least, most = _templates(notices, 0, threshold)
        passages = F.concat(F.array("text"), F.split("text", "\n[ \t\r]*\n"), F.split("text", "\n"))
        counted = F.transform(
            F.array_distinct(passages), lambda p: F.struct(p.alias("text"), (F.regexp_count(p, word) - 1).alias("n"))
        )
        fitting = F.filter(counted, lambda s: (s["n"] >= least) & (s["n"] <= most))
        words = F.transform(fitting, lambda s: F.regexp_extract_all(s["text"], word, F.lit(0)))

        def of_passage(grams: Column) -> Column:
            fits = F.filter(sentences, lambda t: (F.size(grams) >= t["low"]) & (F.size(grams) <= t["high"]))
            return F.transform(fits, lambda t: _found(_score(grams, t), t))

        def of_hits(hits: Column) -> Column:
            known = F.array(F.array_distinct(F.transform(hits, lambda i: F.get("grams", i))))
            starts = lambda t: F.filter(hits, lambda i: F.array_contains(t["bigrams"], F.get("grams", i)))
            scores = lambda k: F.transform(_fitting(k, sentences), lambda t: _found(_best_window(starts(t), t), t))
            return F.flatten(F.transform(known, scores))

        places = "CASE WHEN size(grams) > 0 THEN sequence(0, size(grams) - 1) ELSE array() END"
        hits = F.expr(f"array(filter({places}, i -> grams[i] {_among(every)}))")
        parts += [F.flatten(F.transform(F.transform(words, _bigrams), of_passage)), F.flatten(F.transform(hits, of_hits))]
    if texts:
        whole, every, least, _ = _templates(texts, len(notices), threshold)

        def starts_of(t: Column) -> Column:
            last = F.greatest(F.size("grams") - t["pairs"], F.lit(0))
            return F.array_distinct(F.concat(F.sequence(F.lit(0), last, t["step"]), F.array(last)))

        def of_known(known: Column) -> Column:
            return F.transform(_fitting(known, whole), lambda t: _found(_best_window(starts_of(t), t), t))

        known = F.expr(f"array(array_distinct(filter(grams, g -> g {_among(every)})))")
        parts.append(F.flatten(F.transform(F.filter(known, lambda k: F.size(k) >= least), of_known)))

    found = cut.select("row", F.filter(F.concat(*parts), lambda s: s["dice"] >= threshold).alias("found"))
    best = F.array_max("found")
    return found.select(
        "row",
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        F.array_sort(F.array_distinct(F.transform("found", lambda s: s["name"]))).alias("licenses"),
    )
