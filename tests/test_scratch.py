"""The shared folder is left clean."""

import os
import time

from convocases.sources import scratch


def test_what_was_written_is_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "_written", {})
    monkeypatch.setattr(scratch, "shared_folder", lambda session: f"file://{tmp_path}")
    (tmp_path / "other").mkdir()
    df = scratch.checkpointed(spark.range(5))
    assert df.count() == 5 and len(os.listdir(tmp_path)) == 2
    assert scratch.remove_scratch(spark) == 1 and os.listdir(tmp_path) == ["other"]
    assert scratch.remove_scratch(spark) == 0


def test_shuffle_files_go_when_a_step_is_written(spark):
    """A long plan would else keep the shuffles of all its steps on disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark._jvm.System.gc()  # what earlier tests left goes now
    time.sleep(2)
    before = disk.getAllFiles().size()
    done = scratch.checkpointed(spark.range(100_000).repartition(16, "id"))
    deadline = time.time() + 10
    while disk.getAllFiles().size() > before and time.time() < deadline:
        time.sleep(0.2)
    assert disk.getAllFiles().size() <= before and done.count() == 100_000
    assert spark.conf.get(scratch.RELEASE) == "false"
