"""Checkpoint folder: read from the session, private only when unset and local."""

from kpiforge.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_set_and_stable(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    assert ensure_checkpoint_dir(spark) == d


def test_scratch_paths_are_fresh_and_under_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(ensure_checkpoint_dir(spark))
