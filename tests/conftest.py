import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from slipway.session import get_session
    s = get_session("local[8]", app="slipway-tests", shuffle_partitions=8)
    sc = s.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="slipway-test-ckpt-"))
    yield s


@pytest.fixture()
def store(spark):
    from slipway.store import Store
    return Store.scratch(spark)


@pytest.fixture(scope="session")
def seeds(spark):
    from slipway import schemas
    from slipway.sources import read_seed
    return (read_seed(spark, os.path.join(FIXTURES, "raw_orders.csv"), schemas.RAW_ORDERS),
            read_seed(spark, os.path.join(FIXTURES, "raw_customers.csv"), schemas.RAW_CUSTOMERS))
