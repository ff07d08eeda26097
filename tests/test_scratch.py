"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from stopwise import scratch, storage


def session(master, directory=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: directory or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_clusters_folder_is_used():
    assert scratch.scratch_root(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch.scratch_root(session("local[2]", "/given")) == "/given"


def test_only_a_local_master_may_do_without():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(session("spark://host:7077"))
    assert scratch.scratch_root(session("local[2]")) == scratch.scratch_root(session("local[2]"))


def test_every_call_gives_a_new_folder_and_release_removes_them(spark):
    first, second = scratch.scratch_dir(spark, "t"), scratch.scratch_dir(spark, "t")
    assert first != second
    spark.range(3).write.parquet(first)
    assert storage.exists(spark, first)
    scratch.release_scratch(spark)
    assert not storage.exists(spark, first)


def test_single_folders_can_be_released(spark):
    before = scratch.handed_out()
    kept, gone = scratch.scratch_dir(spark, "kept"), scratch.scratch_dir(spark, "gone")
    for folder in (kept, gone):
        spark.range(1).write.parquet(folder)
    assert scratch.handed_out()[len(before):] == (kept, gone)
    scratch.release_scratch(spark, [gone, "never/handed/out"])
    assert storage.exists(spark, kept) and not storage.exists(spark, gone)
    scratch.release_scratch(spark, [kept])
    assert scratch.handed_out() == before
