import pytest

from sievemark import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Fake:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_workspace_uses_the_shared_folder():
    path = session.workspace(Fake(spark_checkpoint_dir="hdfs://nn/ck/"), "x")
    assert path.startswith("hdfs://nn/ck/sievemark/x-")


def test_workspace_falls_back_only_when_unset():
    a, b = session.workspace(Fake(), "x"), session.workspace(Fake(), "x")
    assert a != b and a.rsplit("/", 2)[0] == b.rsplit("/", 2)[0]


def test_a_cluster_needs_the_shared_folder():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.workspace(Fake(spark_master=master), "x")
        assert session.workspace(Fake(spark_master=master, spark_checkpoint_dir="hdfs://n/c"), "x").startswith("hdfs://n/c/")
