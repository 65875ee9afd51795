"""Session helpers: the checkpoint folder comes from the session."""

from streamledger.session import checkpoint_root, scratch_dir


def test_checkpoint_root_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root.rstrip("/")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/x-")
