import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strataflow import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def values(spark):
    """Values of an expression over a one-column frame ``v`` of text."""

    def run(expression, texts):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
        rows = frame.select("i", expression.alias("out")).orderBy("i").collect()
        return [row["out"] for row in rows]

    return run
