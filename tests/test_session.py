from __future__ import annotations

import pytest

from tierwise import session
from tierwise.sources import tables


def test_reading_leaves_the_session_as_it_was(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tables.trips(spark, "/root/testdata/sf0.001").count()
    assert spark.conf.get(key, None) is None


def test_scratch_folders_are_removed(spark):
    path = session.fresh_dir(spark, "scratch")
    spark.range(3).write.parquet(path)
    before, session._made[:] = list(session._made), [(spark, path)]
    try:
        session.remove_scratch()
    finally:
        session._made[:] = before
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_own_settings_are_kept(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        assert session.configure(spark).conf.get(key) == "1MB"
    finally:
        spark.conf.set(key, before)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Cluster())
