import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# The predictors of the tests are importable in Python workers too.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT / "tests"), str(ROOT), os.environ.get("PYTHONPATH", "")]
).rstrip(os.pathsep)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marginalia.session import build_session

    folder = tempfile.mkdtemp(prefix="marginalia-tests-")
    session = build_session(
        "tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": folder,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_reviews(spark):
    """Make a raw review table from ``(no, rating, review)`` rows."""
    from marginalia.schemas import RAW_SCHEMA

    def make(rows, order=None, partitions=None):
        data = [
            (i + 1, str(no), "Hotel", rating, "Guest", "Room", "1", review)
            for i, (no, rating, review) in enumerate(rows)
        ]
        if order is not None:
            data = [data[i] for i in order]
        df = spark.createDataFrame(data, RAW_SCHEMA)
        return df.repartition(partitions) if partitions else df

    return make
