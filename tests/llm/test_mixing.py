from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from entitylake.llm import mixing

from odd import odd_rows


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, free, target = sum(sizes.values()), set(names), {}
    while True:
        rest = total - sum(most * sizes[s] for s in names if s not in free)
        every = sum(weight[s] for s in free)
        above = {s for s in free if rest * weight[s] / every > most * sizes[s]}
        if not above:
            break
        free -= above
    for s in names:
        target[s] = rest * weight[s] / every if s in free else float(most * sizes[s])
    return target


def plain(rows: list[tuple]) -> list[tuple]:
    groups, sizes = defaultdict(list), defaultdict(int)
    for row in rows:
        text = row[1]
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        own = hashlib.md5((text or "").encode()).hexdigest() if text is not None else ""
        digits = int(hashlib.md5((own if row[0] is None else str(row[0])).encode()).hexdigest()[:13], 16)
        share = sum(c not in mixing.SYMBOLS for c in text) / len(text) if text else 0.0
        draw = -math.log((digits + 0.5) / 2**52) / (0.1 + 0.9 * share)
        groups[row[3]].append((draw, "" if row[0] is None else str(row[0]), size, own, row[0]))
        sizes[row[3]] += size
    found = []
    for source, target in plain_targets(sizes).items():
        words = math.floor(target + 0.5)
        epochs, rest = divmod(words, sizes[source]) if sizes[source] else (0, 0)
        for _, _, size, _, key in sorted(groups[source], key=lambda d: d[:4]):
            part = size if 2 * rest >= size else 0
            rest -= size
            found.append((key, size, sizes[source], round(target, 6), size * epochs + part))
    return sorted(found, key=repr)


def result(docs) -> list[tuple]:
    found = mixing.mixed(docs).select("row.doc_id", "size", "source_size", "target", "taken").collect()
    return sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in found), key=repr)


def test_matches_brute_force(odd):
    assert result(odd) == plain(odd_rows())


@pytest.mark.parametrize("sources", [1, 3, 7])
def test_sources_of_many_sizes(spark, sources):
    rows = [(i, " ".join("w" * (1 + i % 5) for _ in range(i * 7 % 41)), "en", f"s{i * i % (2 * sources) % sources}", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = result(docs)
    assert found == plain(rows)
    assert abs(sum(r[4] for r in found) - sum(r[1] for r in found)) <= sources * (1 + max(r[1] for r in found) / 2)
    assert all(r[4] <= 3 * r[1] for r in found)


def test_rows_of_the_mix(odd, none):
    """Whole documents with all their columns, as often as they are taken."""
    found = mixing.rows_of_mix(odd)
    assert found.columns == odd.columns
    times = Counter()
    for row in mixing.mixed(odd).collect():
        times[row.row] += row.taken // row.size if row.size else 0
    assert Counter(found.collect()) == +times
    assert mixing.mixed(none).count() == 0 and mixing.rows_of_mix(none).count() == 0


def test_rows_without_a_key_are_drawn_by_their_texts(spark):
    rows = [(None, " ".join(["w"] * (3 + i % 9)) + f" {i}", "en", f"s{i % 2}", 0) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert result(docs) == plain(rows)


def test_nothing_but_empty_texts(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    found = mixing.mixed(docs).select("row.doc_id", "size", "target", "taken").collect()
    assert sorted(map(tuple, found)) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_no_python_on_the_way(odd):
    plan = mixing.mixed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
