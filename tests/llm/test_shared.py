"""Tables in the shared folder."""

from types import SimpleNamespace

import pytest

from scriptorium.llm import shared


def test_a_cluster_must_name_its_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=SimpleNamespace(master=master))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.shared_dir(session)


def test_tables_are_written_and_dropped(spark):
    one = shared.written(spark.range(5).withColumnRenamed("id", "x"), "test")
    assert one.columns == ["x"] and one.count() == 5
    before = len(shared._written)
    shared.dropped(one, spark.range(3))
    assert len(shared._written) == before - 1
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(one._scriptorium_path).count()
