from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidegrid.session import local_session

    shared = str(tmp_path_factory.mktemp("stage"))
    session = local_session(4, app="tests", spark__checkpoint__dir=shared,
                            spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """Two short series, one with gaps of many lengths; rows come in no order."""
    def make(series: dict[str, list[float | None]], column: str = "m1"):
        rows = [(s, i, v) for s, values in series.items() for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"series string, pos long, {column} double")
        return df.selectExpr(
            "*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' HOUR * pos AS t"
        ).repartition(3)

    return make
