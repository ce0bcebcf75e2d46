from __future__ import annotations

import pytest

from shoptide import session


class Fake:
    """A session without a configured folder."""

    def __init__(self, master):
        self.values = {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.defaultParallelism = 4000

    def get(self, key, default="200"):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_shared_folder_is_the_configured_one():
    cluster = Fake("yarn")
    cluster.set("spark.checkpoint.dir", "hdfs://shared/")
    one, two = session.new_run_dir(cluster, "x"), session.new_run_dir(cluster, "x")
    assert one.startswith("hdfs://shared/shoptide/x-") and one != two


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake("local-cluster[2,1,1024]"))
    local = Fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_shuffles_follow_the_size_of_the_cluster():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.tune(Fake("yarn")).values[key] == "16000"
    assert key not in session.tune(Fake("local[8]")).values


def test_adaptive_planning_is_put_back(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(RuntimeError), session.adaptive(spark):
            assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
            raise RuntimeError
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
