from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from entitylake.llm import quality

from odd import odd_rows, prose


def plain(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered, seen, repeats = set(), set(), 0
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


TEXTS = ["a\nb\na\n \n \nb", "x y z p q x y z p q r", "#*$ %&|<> a*b", "\n\n", "é ü\né ü\r\né ü", "a b c d e " * 3, "\x1c x\x0b\x0c y"]


@pytest.mark.parametrize("text", TEXTS + [row[1] for row in odd_rows()])
def test_counts(text):
    assert quality.counts((text or "").encode()) == plain(text)


def test_judgement(spark, odd, none):
    words = lambda seed: "".join(c for c in prose(seed, 60) if not c.isdigit()).split()
    good = [(i, " ".join(words(i)), 1) for i in range(30)]
    bad = [(100 + i, " ".join(w + "***%%" for w in words(200 + i)), 0) for i in range(30)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    trusted = docs.where("quality = 1 and doc_id % 2 = 0").select("doc_id")
    ratios = quality.likelihood_ratios(docs, trusted)
    found = quality.judged(docs, ratios).select("row.doc_id", "kept", "score", "n_words").collect()
    assert {r.doc_id for r in found if r.kept} == set(range(30))
    # the same sums, plainly
    both = np.zeros((2, 1 << quality.BITS))
    for i, text, _ in good + bad:
        for place in np.concatenate(list(quality.buckets(text.encode()))):
            both[0, place] += 1
            both[1, place] += i < 30 and i % 2 == 0
    expected = both[0] * both[1].sum() / both[0].sum()
    assert np.allclose(ratios, np.log((both[1] + 0.5) / (expected + 0.5)), atol=1e-6)
    for row in found:
        text = dict((i, t) for i, t, _ in good + bad)[row.doc_id]
        places = np.concatenate(list(quality.buckets(text.encode(), block=50)))
        assert len(places) == len(text.encode()) - 3
        assert abs(row.score - ratios[places].mean()) < 1e-4


def test_odd_rows_and_no_labels(odd, none):
    ratios = quality.likelihood_ratios(odd, none.select("doc_id"))
    assert not ratios.any()
    rows = quality.judged(odd, ratios).select("row.doc_id", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.base_failed == failed and row.kept != failed
    assert quality.good_only(odd, none.select("doc_id")).columns == odd.columns
    assert quality.judged(none, quality.likelihood_ratios(none, none.select("doc_id"))).count() == 0
