import pytest

from ledgerlens.session import checkpoint_root, default_parallelism, remove_scratch, scratch_path


def test_scratch_paths_are_fresh_and_below_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(root.rstrip("/") + "/ledgerlens/x-")


def test_checkpoint_root_is_read_not_replaced(spark):
    before = spark.sparkContext.getCheckpointDir()
    checkpoint_root(spark)
    checkpoint_root(spark)
    assert spark.sparkContext.getCheckpointDir() == before


def test_default_parallelism(spark):
    assert default_parallelism(spark) == spark.sparkContext.defaultParallelism


def test_scratch_folders_can_be_removed_and_nothing_else(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_scratch(spark, checkpoint_root(spark))
