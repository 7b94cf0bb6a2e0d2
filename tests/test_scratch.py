"""Scratch tables stay on shared storage, and go when they are done with."""

import os
from types import SimpleNamespace

import pytest

from assaylake.sources.scratch import checkpoint_dir, clear_scratch, scratch_dir, written_table
from assaylake.sources.metadata import frame


def session(master, configured=None, current=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: current),
    )


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"])
def test_a_cluster_needs_a_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session(master))
    assert checkpoint_dir(session(master, "/shared")) == "/shared"
    assert checkpoint_dir(session(master, None, "/set")) == "/set"


def test_tables_are_removed(spark):
    df = written_table(frame(spark, [(1, "a"), (2, None)], "k int, v string"))
    assert sorted(r["k"] for r in df.collect()) == [1, 2]
    folder = scratch_dir(spark).removeprefix("file:")
    assert os.listdir(folder)
    clear_scratch(spark)
    assert not os.path.exists(folder)
