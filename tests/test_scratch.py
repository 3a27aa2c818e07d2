from types import SimpleNamespace

import pytest

from tidegrain import scratch


def session(master, warehouse, checkpoint=None):
    conf = SimpleNamespace(get=lambda k, d=None: {"spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": warehouse}[k] or d)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master, applicationId="a")
    return SimpleNamespace(conf=conf, sparkContext=context, _jvm=None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: None))


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    monkeypatch.setattr(scratch, "_MADE", {})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.home(session("yarn", "file:/home/me/spark-warehouse"))
    assert scratch.home(session("yarn", "hdfs://n/w")) == "hdfs://n/w/tidegrain-a"
    assert scratch.home(session("yarn", "file:/w", "file:/mnt/shared")) == "file:/mnt/shared/tidegrain-a"
    assert scratch.home(session("local[4]", "file:/w")) == "file:/w/tidegrain-a"
