import pytest

from dockflow import session
from dockflow.plans import derived
from dockflow.plans.derived import Derived


def test_shuffle_partitions_follow_the_input():
    assert session.shuffle_partitions(10 ** 6, 200) == 200
    assert session.shuffle_partitions(2 ** 40, 200) == 4096
    assert session.shuffle_partitions(100 * 10 ** 12, 200) == 372_530  # no bound


def test_shared_dir_is_the_configured_one(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert session.shared_dir(spark) == before.rstrip("/")
    assert session.new_dir(spark, "x").startswith(session.shared_dir(spark))
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


class ClusterStub:
    """A session of a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_dir(ClusterStub)


def test_derived_tables_are_written_once_and_rebuilt_on_change(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("events", "supplier"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    first = Derived(spark, str(tmp_path)).minutes()
    count = len(derived._written)
    assert Derived(spark, str(tmp_path)).minutes().inputFiles() == first.inputFiles()
    assert len(derived._written) == count
    before = Derived(spark, str(tmp_path)).changes().count()
    spark.read.parquet(f"{source}/events.parquet").limit(50).write.mode("append").parquet(
        str(tmp_path / "events.parquet"))
    again = Derived(spark, str(tmp_path)).changes()
    assert len(derived._written) > count and again.count() >= before
