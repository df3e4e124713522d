"""The shared folder and the copies in it."""

from types import SimpleNamespace

import pytest

from barloom.session import cut_lineage, path_exists, remove_copies, shared_dir, temporary_copies


def session(master, named=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named or default), sparkContext=context)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(session("local-cluster[3,2,1024]"))
    assert shared_dir(session("spark://host:7077", named="hdfs://shared/")) == "hdfs://shared"
    assert shared_dir(session("yarn", checkpoint="file:/shared")) == "file:/shared"


def test_copies_are_removed_also_after_a_failure(spark, tmp_path):
    kept, gone = str(tmp_path / "kept"), str(tmp_path / "gone")
    with pytest.raises(RuntimeError), temporary_copies(spark) as keep:
        keep.add(kept)
        cut_lineage(spark.range(3), kept)
        cut_lineage(spark.range(3), gone)
        raise RuntimeError
    assert path_exists(spark, kept) and not path_exists(spark, gone)
    assert remove_copies(spark) >= 1 and not path_exists(spark, kept)
