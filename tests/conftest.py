from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from ledgerflow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SMALL


@pytest.fixture
def small_blocks(spark):
    """Read text in blocks of a few hundred bytes, so that one file spans many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "256")
    spark.conf.set(names[1], "16")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    """The final adaptive plan, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
