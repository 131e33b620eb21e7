import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bizlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", **{
        "spark.master": "local[4]",
        "spark.driver.memory": "4g",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": str(root / "checkpoints"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(
        [("great", 3.1), ("good", 1.9), ("love", 3.2), ("bad", -2.5), ("awful", -2.0), (":)", 2.0),
         ("<3", 1.9), ("kind", 2.4), ("kiss", 1.8), ("death", -2.9)],
        "term string, valence double",
    )


def rows(df):
    """Rows as a sorted list of tuples; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
