import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("accesslens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-accesslens-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def dims(spark):
    """Two owned names, one wildcard, three ranges."""
    from accesslens.sources.dims import Dims

    return Dims(
        domains=spark.createDataFrame(
            [("img.example.com", False, "7"), ("cdn.example.org", True, "9"), ("live.example.net", False, "3")],
            "name string, wildcard boolean, userid string",
        ),
        isp=spark.createDataFrame([(16777216, 33554431, 11), (3000000000, 3100000000, 12)], "lo bigint, hi bigint, code int"),
        prv=spark.createDataFrame([(16777216, 33554431, 8601), (3000000000, 3100000000, 8602)], "lo bigint, hi bigint, code int"),
        area=spark.createDataFrame([("8601", "1000", "10")], "area_id string, area_pid string, area_cid string"),
        machines=spark.createDataFrame(
            [("host-1", "CNC", 12, "TJ", 8622, "c01", "10.0.0.1", 203)],
            "host string, machine_isp string, machine_isp_code int, machine_prv string, machine_prv_code int,"
            "platform string, machine_ip string, pop_id int",
        ),
        parents=spark.createDataFrame([("10.9.9.9",)], "ip string"),
        named=spark.createDataFrame(
            [(16777216, 33554431, 11, "ONE", 1, "P1"), (3000000000, 3100000000, 12, "TWO", 2, "P2")],
            "lo bigint, hi bigint, isp int, isp_name string, prv int, prv_name string",
        ),
    )
