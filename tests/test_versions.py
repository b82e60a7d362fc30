from __future__ import annotations

import os

import pytest
from helpers import rows
from pyspark.sql import types as T

from entitylake.sources import versions
from entitylake.sources.files import Files

SCHEMA = T.StructType(
    [
        T.StructField("base_url", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("last_updated", T.StringType()),
    ]
)


def table(spark, *made):
    return spark.createDataFrame([(url, entity, count, "2024-05-01 10:11:12") for url, entity, count in made], SCHEMA)


def read(spark, root, **options):
    return rows(versions.read_version(spark, root, SCHEMA, **options).select("base_url", "entity", "record_count"))


def written(root: str) -> dict[str, tuple]:
    found = {}
    for folder, _, names in os.walk(f"{root}/data"):
        for name in names:
            if name.endswith(".parquet"):
                state = os.stat(os.path.join(folder, name))
                found[os.path.join(folder, name)] = (state.st_ino, state.st_mtime_ns)
    return found


def test_untouched_environments_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "s")
    assert read(spark, root) == [] and versions.versions(spark, root) == []
    first = table(spark, ("https://a/x=1", "e", 1), ("https://a/x=1", "f", 2), ("b", "e", 3), (None, "e", 4))
    assert versions.commit(first, root) == 1
    before = written(root)
    second = table(spark, ("b", "g", 7), ("b", "g", 8), ("c", "e", 9))
    assert versions.commit(second.coalesce(1), root) == 2
    after = written(root)
    assert all(after[name] == state for name, state in before.items()) and len(after) > len(before)
    assert read(spark, root) == [("b", "g", 8), ("c", "e", 9), ("https://a/x=1", "e", 1), ("https://a/x=1", "f", 2), (None, "e", 4)]
    assert read(spark, root, version=1) == [("b", "e", 3), ("https://a/x=1", "e", 1), ("https://a/x=1", "f", 2), (None, "e", 4)]
    one = versions.read_version(spark, root, SCHEMA, "https://a/x=1")
    assert set(one.inputFiles()) and all("base_url=https" in name for name in one.inputFiles())
    assert read(spark, root, base_url="b") == [("b", "g", 8)] and read(spark, root, base_url="nobody") == []
    assert one.first()["last_updated"].year == 2024
    with pytest.raises(LookupError):
        read(spark, root, version=3)
    # null again, in a version of its own
    versions.commit(table(spark, (None, "z", 5)), root)
    assert [row for row in read(spark, root) if row[0] is None] == [(None, "z", 5)]


def test_nothing_to_commit(spark, tmp_path):
    root = str(tmp_path / "s")
    assert versions.commit(table(spark).limit(0), root) == 0
    versions.commit(table(spark, ("a", "e", 1)), root)
    assert versions.commit(table(spark).limit(0), root) == 1 and read(spark, root) == [("a", "e", 1)]


def test_the_last_row_wins_by_arrival(spark, tmp_path):
    root = str(tmp_path / "s")
    versions.commit(table(spark, ("a", "e", 3), ("a", "e", 5), ("a", "e", 4)), root, arrival="record_count")
    assert read(spark, root) == [("a", "e", 5)]


def test_a_commit_that_meets_another_goes_on_top_of_it(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    versions.commit(table(spark, ("a", "e", 1)), root)
    put, met = Files.put, []

    def meeting(self, name, text, replace=True):
        if not met:
            met.append(name)
            versions.commit(table(spark, ("b", "e", 2)), root)
        return put(self, name, text, replace)

    monkeypatch.setattr(Files, "put", meeting)
    assert versions.commit(table(spark, ("c", "e", 3)), root) == 3
    assert read(spark, root) == [("a", "e", 1), ("b", "e", 2), ("c", "e", 3)]
    assert read(spark, root, version=2) == [("a", "e", 1), ("b", "e", 2)]


def test_a_writer_that_died_leaves_nothing_that_is_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    versions.commit(table(spark, ("a", "e", 1)), root)

    def die(self, name, text, replace=True):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(Files, "put", die)
        with pytest.raises(OSError):
            versions.commit(table(spark, ("a", "e", 2)), root)
    assert read(spark, root) == [("a", "e", 1)] and versions.versions(spark, root) == [1]
    versions.commit(table(spark, ("b", "e", 2)), root)
    assert versions.drop_older(spark, root) == [1]
    assert read(spark, root) == [("a", "e", 1), ("b", "e", 2)] and len(written(root)) == 2
