from types import SimpleNamespace

import pytest

from pathkin.session import shared_dir


def _session(master, conf):
    used = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: used[0] if used else None, setCheckpointDir=used.append
    )
    settings = SimpleNamespace(get=conf.get, set=conf.__setitem__)
    return SimpleNamespace(conf=settings, sparkContext=context), used


def test_the_named_folder_is_used():
    spark, used = _session("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(spark) == "hdfs:///shared" and used == ["hdfs:///shared"]


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(_session("yarn", {})[0])


def test_local_runs_make_one_folder():
    spark, used = _session("local[2]", {})
    assert shared_dir(spark) == shared_dir(spark) == used[0]
