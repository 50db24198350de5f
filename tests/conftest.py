import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinfold.plans.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kinfold-tests-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="kinfold-test-")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def distance(a: str, b: str) -> int:
    """Edit distance by definition, to check against."""
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]
