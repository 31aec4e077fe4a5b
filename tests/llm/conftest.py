import pyarrow.parquet as pq
import pytest
from plain import ODD

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    """Rows of the smallest documents table."""
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


@pytest.fixture()
def odd(spark):
    rows = [r + (1, "mine", 2, "3", 0.5, "k") for r in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, "
        "shard int, component_id string, fp long, key string, score double, node string",
    )


@pytest.fixture()
def empty(odd):
    return odd.where("false")
