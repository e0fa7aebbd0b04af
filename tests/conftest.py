import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    yield s
    s.stop()


# Own rows: crate, weight, place, sealed ("true", "false" or unknown), price.
CRATES = [
    ("K1", 4.0, "dock", "true", 9.5), ("K1", 9.0, "yard", "false", 3.0), ("K2", None, "dock", "true", 6.25),
    ("K3", 2.5, "yard", None, 2.5), ("K4", 16.0, "shed", "false", None), ("K5", 9.0, "dock", "true", 31.0),
    ("K3", 7.0, "dock", "false", 12.0), ("K6", 4.0, "shed", None, 4.0), ("K3", 11.0, "yard", "true", 8.75), ("K7", None, "dock", "true", None),
]


@pytest.fixture(scope="session")
def crates(spark):
    return spark.createDataFrame(CRATES, "crate string, weight double, place string, sealed string, price double").cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
