from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from flowmart import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "flowmart-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def values(spark):
    """Evaluate a Column function over a list of texts, keeping their order."""

    def run(function, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        result = df.select("i", function(df.x).alias("y")).collect()
        return [r.y for r in sorted(result, key=lambda r: r.i)]

    return run
