"""Shared folder, scratch folders and partition sizing."""

from tasteflow.session import checkpointed, scratch_dir, shared_dir


def test_shared_dir_reads_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark).rstrip("/") == root.rstrip("/")
    assert shared_dir(spark, "a", "b") == root.rstrip("/") + "/a/b"
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_dirs_are_never_reused(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    import pytest

    from tasteflow import session

    class Context:
        master = "spark://somewhere:7077"
        def getCheckpointDir(self):  # noqa: E301
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    cluster = type("S", (), {"sparkContext": Context(), "conf": Conf()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_checkpointed_cuts_lineage(spark):
    df = checkpointed(spark.range(10).selectExpr("id * 2 AS v"))
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in df.collect()) == list(range(0, 20, 2))
