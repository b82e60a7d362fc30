from __future__ import annotations

import pytest

from entitylake.session import checkpoint_root, materialized, scratch_dir


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """Stands for a session: settings and context."""

    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.setting = setting

    @property
    def conf(self):
        return self

    def get(self, key, default):
        return self.setting if key == "spark.checkpoint.dir" and self.setting else default


def test_the_setting_of_the_cluster_counts():
    session = Session("yarn", "hdfs:///shared/")
    assert checkpoint_root(session) == "hdfs:///shared"
    assert session.sparkContext.folder == "hdfs:///shared/"
    assert checkpoint_root(Session("yarn", folder="hdfs:///set")) == "hdfs:///set"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session("spark://host"))


def test_a_local_session_makes_its_own():
    session = Session("local[2]")
    assert checkpoint_root(session) == checkpoint_root(session) == session.sparkContext.folder


def test_scratch_paths_differ(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_materialized(spark):
    df = spark.sql("SELECT 1 AS `a@b`, timestamp_ntz'2024-01-01' AS t, array(named_struct('x', 1)) AS l")
    stored = materialized(df)
    assert stored.schema.simpleString() == df.schema.simpleString() and stored.collect() == df.collect()
