import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from llm_data import SCHEMA, rows  # noqa: E402


@pytest.fixture(scope="session")
def frame(spark):
    return lambda texts: spark.createDataFrame(rows(texts), SCHEMA).repartition(3)
