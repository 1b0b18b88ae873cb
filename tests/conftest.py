from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def make_session(cores: str = "*", shuffle_partitions: int = 8):
    from gridtally.plans.session import builder

    scratch = tempfile.mkdtemp(prefix="gridtally-test-")
    spark = (
        builder("gridtally-tests", shuffle_partitions=shuffle_partitions, conf={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.local.dir": f"{scratch}/local",
        })
        .master(f"local[{cores}]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    s = make_session()
    yield s
    s.stop()
