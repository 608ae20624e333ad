from __future__ import annotations

from types import SimpleNamespace

import pytest

from loomvec.session import shared_folder


def test_a_cluster_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, applicationId="a")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_the_named_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
