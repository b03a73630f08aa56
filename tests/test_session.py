"""The folder that driver and executors share."""

from types import SimpleNamespace

import pytest

from addrspark.session import shared_folder


def session(master, **settings):
    held = dict(settings)
    conf = SimpleNamespace(get=lambda name, default=None: held.get(name, default), set=held.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)), held


def test_the_named_folder_is_used():
    spark, _ = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_folder(spark) == "hdfs:///shared"


def test_a_cluster_must_name_one():
    spark, _ = session("spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)


def test_a_local_session_gets_one_and_keeps_it():
    spark, held = session("local[2]")
    folder = shared_folder(spark)
    assert folder.startswith("file:///") and held["addrspark.scratch"] == folder and shared_folder(spark) == folder
