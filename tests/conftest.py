import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tributary.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, "tests", **{"spark.checkpoint.dir": str(shared), "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def values(spark):
    """Results of a column expression over a list of texts, in order."""
    from pyspark.sql import functions as F

    def run(texts, expression, kind="string"):
        df = spark.createDataFrame(list(enumerate(texts)), f"i int, x {kind}")
        rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run
