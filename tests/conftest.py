import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from glyphvec.session import local_session, ship_package


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session, str(ROOT / "checks"))
    session.sparkContext.addPyFile(str(ROOT / "tests" / "providers.py"))
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column function over texts: one result per text, in order."""
    from pyspark.sql import functions as F

    def run(texts, column):
        df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
        return [r["v"] for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]

    return run
