import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def strained(spark):
    """Every strained text with extra columns whose names clash with those of operators."""
    from cases import SCHEMA, rows

    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
