import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from auctionflow.session import local_session
    s = local_session("*", shuffle_partitions=8, app="auctionflow-tests",
                      extra={"spark.driver.memory": "4g",
                             "spark.sql.streaming.stateStore.providerClass":
                             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    yield s


def rows(df, cols=None):
    """Sorted list of tuples (for order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
