"""The shared-folder rule: scratch space lives under spark.checkpoint.dir."""

from lakesmith.session import fresh_dir, scratch_dir


def test_scratch_under_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root
    assert scratch_dir(spark, "x").startswith(root.removeprefix("file:"))


def test_fresh_dirs_are_unique(spark):
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")
