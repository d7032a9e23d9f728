import os
import sys

import pytest

_here = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_here), _here]

from lotwise.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("lotwise-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("LOTWISE_SF_DIR", "/root/testdata/sf0.001")
