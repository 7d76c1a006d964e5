import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import SCHEMA, corpus


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
