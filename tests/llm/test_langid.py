from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from entitylake.llm import langid

from odd import odd_rows

SYLLABLES = {"en": "the and ing of tion er ly wh", "de": "sch ein ung für über lich ch zu", "fr": "eau oui é le ère ment que x"}


def text(lang: str, seed: int, n: int) -> str:
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SYLLABLES[lang].split()) for _ in range(draw.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(lang, i, 5 + i % 40), lang) for i, lang in enumerate(["en", "de", "fr", "en"] * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def plain_model(texts: list[str]):
    """Interpolated Kneser-Ney over strings, straight from its definition."""
    order = langid.ORDER
    counts = Counter()
    for own in texts:
        own = langid.letters(own).tobytes().decode("utf-32-le")
        counts.update(own[i : i + order] for i in range(len(own) - order + 1))
    levels = []
    for n in range(order, 0, -1):
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        total, kinds = defaultdict(int), defaultdict(list)
        for gram, c in counts.items():
            total[gram[:-1]] += c
            kinds[gram[:-1]].append(c)
        levels.insert(0, (dict(counts), total, kinds, once / (once + 2 * twice) if once and twice else 0.5))
        counts = Counter(gram[1:] for gram in counts)
    return levels


def plain_probability(levels, gram: str, letters: int) -> float:
    found = 1 / letters
    for n, (counts, total, kinds, discount) in enumerate(levels, 1):
        own = gram[len(gram) - n :]
        if own[:-1] in total:
            rest = sum(min(c, discount) for c in kinds[own[:-1]])
            found = (max(counts.get(own, 0) - discount, 0) + rest * found) / total[own[:-1]]
    return found


def test_model_matches_the_definition(docs):
    model = langid.fitted(docs, sample=12)
    assert model.names == ["de", "en", "fr"] and np.isfinite(model.limits).all()
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    ranks = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text) h").collect()}
    for place, lang in enumerate(model.names):
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: ranks[r.doc_id])[:12]
        own = [r for place, r in enumerate(own, 1) if place % langid.CALIBRATION]
        levels = plain_model([r.text for r in own])
        for tried in ("the schule eau", "Überlichung!", "x", own[0].text):
            points = langid.letters(tried)
            string = points.tobytes().decode("utf-32-le")
            grams = [string[i : i + 4] for i in range(len(string) - 3)]
            expected = [plain_probability(levels, g, model.letters) for g in grams]
            found = np.exp(model.scores(points)[:, place])
            assert np.allclose(found, expected, rtol=1e-4)


def test_probabilities_sum_to_one(docs):
    model = langid.fitted(docs, sample=20)
    every = sorted({int(c) for r in docs.collect() for c in langid.letters(r.text)})
    for context in ("the", " sc", "xyz", "   "):
        points = np.array([[*map(ord, context), c] for c in every + [0x4E00]], np.uint32)
        for language in model.languages:
            assert language.probability(points, model.letters).sum() == pytest.approx(1, abs=1e-6)


def test_held_out_accuracy_and_rejection(spark, docs):
    model = langid.fitted(docs)
    found = langid.identified(docs, model).join(docs, "doc_id").collect()
    apart = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(apart) > 30
    assert sum(r.lang == r.lang_pred for r in apart) / len(apart) > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.rejected for r in found) < 0.02 * len(found)
    strange = spark.createDataFrame([(1, "zzyq qqzz jjkk vvbb " * 20)], "doc_id long, text string")
    assert langid.identified(strange, model).first().rejected


def test_labels_of_held_out_documents_are_not_used(spark, docs):
    rows = [(r.doc_id, r.text, "xx" if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.lang) for r in docs.collect()]
    other = spark.createDataFrame(rows, docs.schema)
    assert "xx" not in langid.fitted(other).names


def test_odd_rows(odd, none):
    model = langid.fitted(odd)
    found = {(r.doc_id, r.lang_pred, r.score) for r in langid.identified(odd, model).collect()}
    assert len(langid.identified(odd, model).collect()) == len(odd_rows())
    for key, value, *_ in odd_rows():
        letters = any(c.isalpha() for c in value or "")
        own = {(p, s) for k, p, s in found if k == key}
        assert letters or ("und", 0.0) in own
    assert {p for _, p, _ in found} <= {"en", "und"}
    nothing = langid.fitted(none)
    assert nothing.names == [] and langid.identified(none, nothing).count() == 0
    assert {r.lang_pred for r in langid.identified(odd, nothing).collect()} == {"und"}


def test_null_and_repeated_keys_do_not_multiply_the_sample(spark, monkeypatch):
    """300 rows without a key are 300 rows to draw from; equal rows count once."""
    rows = [(None, text("en", i, 8), "en") for i in range(300)] + [(1, text("de", i % 3, 9), "de") for i in range(60)]
    trained = []
    monkeypatch.setattr(langid, "_grams", lambda docs, grams=langid._grams: trained.append(docs.collect()) or grams(docs))
    model = langid.fitted(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=1000)
    count = Counter(row.lang for row in trained[0])
    assert count["en"] == 240 and count["de"] == 3 and model.names == ["de", "en"]
    assert max(Counter((row.lang, row.text) for row in trained[0]).values()) == 1


def test_no_n_gram_is_dropped(docs):
    model = langid.fitted(docs, sample=40)
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    ranks = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text) h").collect()}
    for place, lang in enumerate(model.names):
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: ranks[r.doc_id])[:40]
        grams = set()
        for n, row in enumerate(own, 1):
            if n % langid.CALIBRATION:
                points = langid.letters(row.text).tobytes().decode("utf-32-le")
                grams |= {points[i : i + langid.ORDER] for i in range(len(points) - langid.ORDER + 1)}
        assert len(model.languages[place].levels[-1].grams) == len(grams)
