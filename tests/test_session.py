import os

import pytest

from gridtally.plans.session import (
    DEFAULT_CONF, drop_staged, shared_dir, sizing_conf, staging_path,
)


def test_shared_dir_from_session(spark):
    d = shared_dir(spark)
    assert d == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
    assert staging_path(spark, "x").startswith(d + "/staged/x-")


def test_defaults_leave_the_optimizer_alone():
    assert not any("optimizer" in k for k in DEFAULT_CONF)


def test_sizing_follows_the_input_without_a_clamp():
    big = sizing_conf(100 * 2**40, 3000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    share = sizing_conf(100 * 2**40, 3000, shuffle_share=1 / 32)
    assert int(share["spark.sql.shuffle.partitions"]) == 12800
    small = sizing_conf(10**9, 300)
    assert int(small["spark.sql.shuffle.partitions"]) == 600
    assert int(small["spark.sql.files.maxPartitionBytes"]) == -(-10**9 // 600)


def test_only_staged_folders_are_dropped(spark, tmp_path):
    path = staging_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_staged(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        drop_staged(spark, str(tmp_path))
    assert spark.sparkContext.getConf().get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"


def test_a_local_warehouse_is_refused_on_a_cluster():
    from gridtally.plans.session import _check_shared

    for master in ("local", "local[8]", "local-cluster[3,2,1024]"):
        _check_shared("file:/home/x/spark-warehouse/_gridtally", "file", master)
    _check_shared("hdfs://store/warehouse/_gridtally", "hdfs", "yarn")
    for master in ("yarn", "spark://head:7077", "k8s://https://head"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _check_shared("file:/home/x/spark-warehouse/_gridtally", "file", master)
