import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from edge_cases import CLASHES, COLUMNS, EDGES  # noqa: E402


@pytest.fixture
def edges(spark):
    """Documents with every odd case, and columns with clashing names."""
    rows = [(*r, -1, True, 5, 6, 0.5, 1.0, [1], "x", "y") for r in EDGES]
    return spark.createDataFrame(rows, f"{COLUMNS}, {CLASHES}")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def edge_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (6, 1, None), (None, 0, 1), (7, None, 0), (7, 0, 1), (8, 0, 0), (8, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
