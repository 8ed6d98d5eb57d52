from types import SimpleNamespace

import pytest

from pagelake.session import fresh_dir, work_dir


def test_work_dir_is_set_once(spark):
    first = work_dir(spark)
    assert work_dir(spark) == first
    assert fresh_dir(spark, "x").startswith(first) and fresh_dir(spark, "x") != fresh_dir(spark, "x")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(fake)
