import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.session import get_spark  # noqa: E402
from stratum.sources.raw import INGESTION_TS, RAW_COLUMNS  # noqa: E402



@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[*]", shuffle_partitions=8, app_name="stratum-tests")
    yield s


@pytest.fixture
def raw_rows(spark):
    """Build a raw feed from dicts; absent keys are NULL, load time defaults to a constant."""
    def make(rows):
        base = dt.datetime(2024, 1, 20, 8, 0)
        data = [tuple(r.get(c) for c in RAW_COLUMNS) + (r.get(INGESTION_TS, base),) for r in rows]
        schema = ", ".join(f"{c} string" for c in RAW_COLUMNS) + f", {INGESTION_TS} timestamp_ntz"
        return spark.createDataFrame(data, schema)
    return make
