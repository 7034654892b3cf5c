"""Where intermediate tables go: the named shared folder, on one machine one beside the warehouse, else nowhere."""

import types

import pytest

from covercast import shared


def session(master, checkpoint=None, named=None):
    """What ``shared_folder`` reads of a session."""
    confs = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/w/"}
    context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    conf = types.SimpleNamespace(get=lambda key, default=None: confs.get(key) or default)
    return types.SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_comes_first():
    assert shared.shared_folder(session("spark://a", named="hdfs://x/")) == "hdfs://x"
    assert shared.shared_folder(session("spark://a", "hdfs://y/1", "hdfs://x/")) == "hdfs://y/1"


def test_without_one_only_a_single_process_has_a_folder():
    for master in ("local", "local[8]", "local[*]"):
        assert shared.shared_folder(session(master)) == "/w/_work"
    for master in ("local-cluster[3,2,1024]", "spark://a:7077", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared.shared_folder(session(master))


def test_stored_tables_can_be_read_again(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) AS x")
    kept = shared.stored(df, "t")
    assert kept.dtypes == df.dtypes and kept.count() == 5 and kept.inputFiles()
