import os

import pytest

from harborline.llm import common


def under(path):
    return sum(len(names) for _, _, names in os.walk(path))


def test_settled_frames_can_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    before = spark.conf.get(common._FREE, None)
    one, two = common.settle(spark.range(5).repartition(2)), common.settle(spark.range(3))
    assert (one.count(), two.count()) == (5, 3) and spark.conf.get(common._FREE, None) == before
    held = under(tmp_path)
    common.forget(one, spark.range(1))  # a frame that isn't settled is left alone
    assert 0 < under(tmp_path) < held and two.count() == 3
    common.clean_up(spark)
    assert under(tmp_path) == 0


class Session:
    """A session of which only settings are asked."""

    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_the_shared_folder_is_the_cluster_s():
    cluster = Session(spark__master="local-cluster[2,1,1024]", spark__app__id="a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(cluster)
    assert common.shared_dir(Session(spark__checkpoint__dir="s3://x/y/", spark__master="yarn")) == "s3://x/y"
    local = common.shared_dir(Session(spark__master="local[2]", spark__app__id="b"))
    assert os.path.isdir(local) and common.shared_dir(Session(spark__master="local[2]", spark__app__id="b")) == local
