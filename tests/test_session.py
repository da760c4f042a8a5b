"""The shared folder on a cluster: a ``file:`` folder may be a mount that all machines have."""

from pathlib import Path

import pytest
from pyspark import SparkConf
from pyspark.sql import DataFrameWriter

from sitelens import session
from sitelens.session import materialize, shared_table_path


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    monkeypatch.setattr(session, "_SEEN", set(), raising=False)
    assert spark.sparkContext.getCheckpointDir().startswith("file:")
    return spark


def test_a_mount_of_all_machines_serves_a_cluster(cluster):
    assert sorted(r.id for r in materialize(cluster.range(5), "shared").collect()) == [0, 1, 2, 3, 4]
    assert len(session._SEEN) == 1


def test_a_folder_of_each_machine_is_refused(cluster, monkeypatch):
    write = DataFrameWriter.parquet

    def one_machine_apart(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        next(Path(path.removeprefix("file:")).glob("part-*")).unlink()

    monkeypatch.setattr(DataFrameWriter, "parquet", one_machine_apart)
    with pytest.raises(RuntimeError, match="do not see it"):
        shared_table_path(cluster, "apart")
    assert not session._SEEN


def test_a_cluster_without_a_checkpoint_folder_uses_its_warehouse(cluster, monkeypatch, scratch):
    sc, now = cluster.sparkContext, []
    monkeypatch.setattr(sc, "getCheckpointDir", lambda: now[-1] if now else None)
    monkeypatch.setattr(sc, "setCheckpointDir", lambda folder: now.append(f"file:{folder}/application"))
    monkeypatch.setattr(sc, "getConf", lambda: SparkConf(loadDefaults=False))
    known = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": f"{scratch}/warehouse/"}
    get = type(cluster.conf).get
    monkeypatch.setattr(type(cluster.conf), "get", lambda conf, key, *default: known[key] if key in known else get(conf, key, *default))
    assert shared_table_path(cluster, "t").startswith(f"file:{scratch}/warehouse/_sitelens/application/tables/t-")
    assert session.shared_root(cluster) == f"file:{scratch}/warehouse/_sitelens"
    assert len(now) == len(session._SEEN) == 1
