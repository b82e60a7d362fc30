from __future__ import annotations

import re

import duckdb

from entitylake.llm import licenses
from entitylake.llm.queries import QUERIES
from entitylake.llm.sql import LICENSE_SCAN

from odd import odd_rows, prose


def grams_of(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def in_passages(text: str) -> list[tuple]:
    """``(shared, dice, -place, name)`` of notices in lines, paragraphs and the whole text, by plain code."""
    lower, found = text.lower(), []
    for passage in {lower, *re.split("\n[ \t\r]*\n", lower), *lower.split("\n")}:
        grams = grams_of(passage)
        for place, (name, notice) in enumerate(licenses.NOTICES):
            own = set(grams_of(notice))
            shared = len(set(grams) & own)
            found.append((shared, 2.0 * shared / (len(grams) + len(own)), -place, name))
    return found


def in_windows(text: str) -> list[tuple]:
    """The same of the best window for each notice and each text."""
    grams, found = grams_of(text), []
    for place, (name, template) in enumerate(licenses.NOTICES + licenses.TEXTS):
        size, own = len(grams_of(template)), set(grams_of(template))
        last = max(len(grams) - size, 0)
        if place < len(licenses.NOTICES):
            starts = [i for i, gram in enumerate(grams) if gram in own]
        else:
            starts = [*range(0, last, max(1, size // licenses.SHARE)), last] if grams else []
        windows = [set(grams[i : i + size]) for i in starts]
        if windows:
            dice, shared = max((2.0 * len(w & own) / (len(w) + len(own)), len(w & own)) for w in windows)
            found.append((shared, dice, -place, name))
    return found


def plain(text: str | None) -> tuple:
    found = [one for one in in_passages(text or "") + in_windows(text or "") if one[1] >= licenses.THRESHOLD]
    best = max(found, default=(0, None, 0, None))
    return (best[3], best[1], sorted({name for *_, name in found}))


TEXTS = [
    "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words.", "licensed under cc by-sa 4.0", "MIT License",
    "This work is licensed\nunder the GNU General Public\nLicense, version 2.\n \nOther", "All rights reserved. All rights reserved.",
    "Released under the MIT License.\nReleased under the ISC License.", "RELEASED UNDER THE MIT LICENSE", "all rights reserved " * 2000,
]


def test_matches_brute_force(spark, odd, none):
    rows = [(row[0], row[1]) for row in odd_rows()]
    found = licenses.scanned(odd).select("row.doc_id", "license", "dice", "licenses").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(((i, *plain(t)) for i, t in rows), key=repr)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    found = licenses.scanned(docs).select("row.doc_id", "license", "dice", "licenses").collect()
    assert sorted(map(tuple, found)) == sorted((i, *plain(t)) for i, t in enumerate(TEXTS))
    assert [r.license for r in sorted(found)][:4] == ["Apache-2.0", "CC-BY-SA-4.0", None, "GPL-2.0"]
    assert licenses.scanned(none).count() == 0


def whole_texts() -> tuple[list[str], list[str]]:
    texts, names = [], []
    for name, template in licenses.TEXTS:
        comment = "\n".join(f" * {line}" for line in template.split("\n"))
        texts.append(f"Some file. Copyright (c) 2020 Some One\n\n/*\n{comment}\n */\nint main() {{ return 0; }} // the end of it")
        names.append(name)
    texts += [texts[names.index("ISC")].replace("purpose", "aim"), " ".join(texts[names.index("Zlib")].split()[:40])]
    return texts, names


def test_whole_texts_and_headers_in_customary_lines(spark):
    texts, names = whole_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = sorted(licenses.scanned(docs).select("row.doc_id", "license", "dice", "licenses").collect())
    assert [r.license for r in found] == [*names, "ISC", None]
    assert [tuple(r) for r in found] == [(i, *plain(t)) for i, t in enumerate(texts)]


LINES = [
    ("This file is Licensed under the Apache License, Version 2.0. See the LICENSE file for details.", "Apache-2.0"),
    ("# Released under the MIT License by the Foo authors; see their page for what else there is.", "MIT"),
    ("Copyright (c) 2020 X. All rights reserved.", "Proprietary"),
    ("It was released under the old rules of the license that the MIT has.", None),
    ("All of the rights are reserved for those who asked; rights, reserved or not, are all the same.", None),
]


def test_notices_inside_longer_lines(spark):
    texts = [text for text, _ in LINES] + [f"{prose(9, 3000)} {text}\n{prose(10, 3000)}" for text, _ in LINES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = sorted(licenses.scanned(docs).select("row.doc_id", "license", "dice", "licenses").collect())
    assert [r.license for r in found] == [name for _, name in LINES] * 2
    assert [tuple(r) for r in found] == [(i, *plain(t)) for i, t in enumerate(texts)]


def test_sql_finds_the_same_in_notices_and_whole_texts(spark, tmp_path):
    texts = [*whole_texts()[0], *TEXTS, *(text for text, _ in LINES), None, "", "one", f"{prose(11, 500)} {LINES[1][0]} {prose(12, 500)}"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = duck.execute(LICENSE_SCAN).fetchall()
    found = QUERIES["op6_license_scan"](spark, str(tmp_path))
    assert sorted(map(tuple, found.select("doc_id", "license", "dice", "licenses").collect())) == sorted(expected)


def test_only_texts_or_only_notices(spark):
    texts, names = whole_texts()
    docs = spark.createDataFrame([(0, texts[names.index("MIT")])], "doc_id int, text string")
    (one,), (two,) = (licenses.scanned(docs, **part).collect() for part in ({"notices": ()}, {"texts": ()}))
    assert one.license == two.license == "MIT" and one.dice == two.dice == 1


def test_size_bounds_are_tight():
    for size in range(1, 40):
        low, high = licenses.bounds(size, 0.8)
        reach = [n for n in range(1, 200) if 2 * min(n, size) >= 0.8 * (n + size)]
        assert (low, high) == (reach[0], reach[-1])


def test_no_python_on_the_way(odd):
    plan = licenses.scanned(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
