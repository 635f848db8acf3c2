from types import SimpleNamespace

import pytest

from sparcel import session


def fake(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=SimpleNamespace(master=master))


def test_shared_folder():
    for master in ("local", "local[4]", "local[*]"):
        assert session.shared_folder(fake(master))
    for master in ("local-cluster[3,2,1000]", "spark://host:7077", "yarn", "k8s://x"):
        assert session.shared_folder(fake(master, "hdfs:///shared/")) == "hdfs:///shared"
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(fake(master))
