import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def daily(spark):
    """Builds ``area_id, ts, value`` from {area: values}, one value per step from 2024-01-01 on."""

    def build(areas, step=timedelta(days=1), start=datetime(2024, 1, 1)):
        rows = [(a, start + i * step, None if v is None else float(v)) for a, vs in areas.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, "area_id int, ts timestamp_ntz, value double")

    return build


def column(frame, name, order=("area_id", "ts")):
    return [r[name] for r in frame.orderBy(*order).collect()]
