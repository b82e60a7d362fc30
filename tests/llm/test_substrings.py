from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from entitylake.llm import substrings

from odd import odd_rows, prose


def plain(rows: list[tuple], window: int) -> list[tuple]:
    words = [re.findall(r"[^\x20\x09-\x0D]+", row[1] or "") for row in rows]
    times = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    found = []
    for row, own in zip(rows, words):
        gone = set()
        for i in range(len(own) - window + 1):
            if times[tuple(own[i : i + window])] > 1:
                gone.update(range(i, i + window))
        found.append((row[0], len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"group": 1}, {"gram": 3}, {"window": 5}, {"window": 1}])
def test_matches_brute_force(odd, sizes):
    found = substrings.without_repeats(odd, **sizes).select("row.doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == plain(odd_rows(), sizes.get("window", substrings.WINDOW))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=40), min_size=1, max_size=6), st.integers(1, 6))
def test_deep_leaves_are_the_repeated_windows(texts, window):
    segments = Counter(" ".join(t).encode() for t in texts if len(t) >= window)
    times = Counter()
    for segment, n in segments.items():
        words = segment.split()
        for i in range(len(words) - window + 1):
            times[tuple(words[i : i + window])] += n
    for (segment, _), found in zip(segments.items(), substrings.deep_leaves(list(segments.items()), window)):
        words = segment.split()
        expected = [i for i in range(len(words) - window + 1) if times[tuple(words[i : i + window])] > 1]
        assert sorted(found) == expected


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "a\x01"]), min_size=1, max_size=20), min_size=1, max_size=5), st.integers(1, 4))
def test_inner_nodes_are_the_repeats_that_end_where_texts_part(texts, window):
    suffixes = sorted("".join(w + " " for w in t[i:]).encode() for t in texts for i in range(len(t)))
    words = [s.split() for s in suffixes]
    after: dict[tuple, list] = {}
    for own in words:
        for n in range(window, len(own) + 1):
            after.setdefault(tuple(own[:n]), []).append(own[n] if n < len(own) else None)
    expected = {r: len(a) for r, a in after.items() if len(a) > 1 and (len(set(a)) > 1 or None in a)}
    nodes = substrings.inner_nodes(suffixes, window)
    assert {tuple(words[first][:depth]): last - first + 1 for depth, first, last in nodes} == expected
    assert len(nodes) == len(expected)


def test_runs_of_equal_rows_are_not_gathered_for_each_copy(spark):
    docs = spark.createDataFrame([(None, prose(21, 200))] * 40 + [(1, prose(22, 50))], "doc_id long, text string")
    found = substrings.repeated_windows(substrings.with_id(docs, "doc_id", "text").select("id1", "id2", "text")).collect()
    assert len(found) == 1
    spans = [tuple(run) for run in found[0].runs]
    assert len(spans) == len(set(spans)) and {n for a, b in spans for n in range(a, b + 1)} == set(range(166))


def test_equal_windows_have_equal_anchors():
    words = prose(11, 400).split()
    hashes = substrings._hashes([w.encode() for w in words])
    whole, keys = substrings.anchors(hashes, 35, 8)
    assert whole[0] == 0 and (np.diff(whole) > 0).all()
    for start in range(0, 300, 37):
        own = substrings.anchors(hashes[start : start + 35], 35, 8)[1]
        place = np.searchsorted(whole, start, side="right") - 1
        assert own[0] == keys[place]


def test_cleaned_keeps_rows_and_untouched_texts(odd, none):
    found = substrings.cleaned(odd)
    assert found.columns == odd.columns
    before = {(r[0], r[2], r[3]): r[1] for r in odd_rows()}
    rows = found.collect()
    assert len(rows) == len(odd_rows())
    removed = {r[0] for r in plain(odd_rows(), 35) if r[2]}
    for row in rows:
        if row.doc_id is not None and row.doc_id not in removed:
            assert row.text == before[row.doc_id, row.lang, row.source]
        assert row.n_chars == (None if row.text is None else len(row.text))
    assert substrings.cleaned(none).count() == 0


@given(st.sets(st.integers(0, 60)))
def test_runs_cover_the_same_numbers(numbers):
    found = substrings.runs(sorted(numbers))
    assert [n for run in found for n in range(run["first"], run["last"] + 1)] == sorted(numbers)
    assert all(a["last"] + 1 < b["first"] for a, b in zip(found, found[1:]))
