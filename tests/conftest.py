import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent
sys.path[:0] = [str(ROOT.parent), str(ROOT)]

from daytally.plans.tables import CalcTables  # noqa: E402
from daytally.session import local_session, run_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    return CalcTables(spark, f"calc_{uuid.uuid4().hex[:12]}", run_dir(spark, "tables"), buckets=4).create()


@pytest.fixture
def events(spark):
    """Builds events from (user_id, start_time, upload_time, value)."""

    def build(*rows):
        return spark.createDataFrame(
            [(u, s, t, v) for u, s, t, v in rows],
            "user_id string, start_time string, upload_time string, value double",
        ).selectExpr(
            "user_id",
            "CAST(start_time AS TIMESTAMP_NTZ) AS start_time",
            "CAST(upload_time AS TIMESTAMP_NTZ) AS upload_time",
            "value",
        )

    return build
