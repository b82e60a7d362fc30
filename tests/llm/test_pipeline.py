"""The pipeline's stages against plain code, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from check import SAME_TYPES, bag
from entitylake.llm import quality
from entitylake.llm.queries import ORACLES, QUERIES, trusted_ids
from entitylake.session import materialized

import test_mixing
import test_simhash
import test_substrings

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_registered():
    assert {*QUERIES, "pipeline"} <= driver.queries().keys()
    assert ORACLES.items() <= driver.oracle_sql().items()
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLES[name])
    columns = [item[0] for item in found.description]
    assert {i[0]: SAME_TYPES.get(str(i[1]), str(i[1])) for i in found.description} == dict(df.dtypes)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, found.fetchall())


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query_returns_every_row_once(spark, name):
    df = QUERIES[name](spark, FOLDER)
    key = df.columns[0]
    source = {"page_id": "pages", "vec_id": "embeddings", "query_id": "embeddings"}.get(key, "documents")
    table = spark.read.parquet(f"{FOLDER}/{source}.parquet")
    rows = df.where("piece = 0") if "piece" in df.columns else df
    if key == "query_id":
        rows, table = df.where("rank = 10"), table.where("vec_id % 100 = 0").withColumnRenamed("vec_id", key)
    assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in table.select(key).collect())


def test_stages_match_plain_code(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ratios = quality.likelihood_ratios(docs, trusted_ids(spark, FOLDER))
    rows = [tuple(r) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    assert len(names) == 5

    def step(name: str, own):
        found = materialized(stages[name](spark, own, FOLDER), "stage")
        return found, sorted((tuple(r) for r in found.collect()), key=repr)

    kept = []
    for row in rows:
        n_words, _, _, _, n_repeat = quality.counts((row[1] or "").encode())
        places = [int(p) for part in quality.buckets((row[1] or "").encode()) for p in part]
        score = sum(float(ratios[p]) for p in places) / max(len(places), 1)
        if n_words >= 10 and 100 * n_repeat <= 20 * n_words and score >= quality.THRESHOLD:
            kept.append(row)
    docs, found = step(names[0], docs)
    assert found == sorted(kept, key=repr) and 0 < len(kept) < len(rows)

    rows = kept
    prints = [test_simhash.plain(row[1]) for row in rows]
    chosen = set(test_simhash.groups(rows, prints, 2))
    kept = [row for row in rows if row[0] in chosen]
    docs, found = step(names[1], docs)
    assert found == sorted(kept, key=repr) and len(kept) < len(rows)

    cut = {row[0]: row for row in test_substrings.plain(kept, 35)}
    rows = []
    for row in kept:
        text = cut[row[0]][3] if cut[row[0]][2] else row[1]
        rows.append((row[0], text, row[2], row[3], len(text)))
    docs, found = step(names[2], docs)
    assert found == sorted(rows, key=repr) and any(row[2] for row in cut.values())

    taken = {row[0]: row[4] for row in test_mixing.plain(rows)}
    expected = []
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1])
        expected += [row] * (taken[row[0]] // len(words) if words else 0)
    docs, found = step(names[3], docs)
    assert found == sorted(expected, key=repr)

    packed = stages[names[4]](spark, docs, FOLDER).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in found)
    bins = defaultdict(list)
    for row in packed:
        bins[row.sequence_id].append((row.offset, row.length))
    for content in bins.values():
        content.sort()
        assert [o for o, _ in content] == [sum(n for _, n in content[:i]) for i in range(len(content))]
        assert sum(n for _, n in content) <= 2048


def test_run_is_all_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset"} <= set(found.columns) and found.count() > 0
