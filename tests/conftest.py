import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]

from given import DATA


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    from ledgerloop.plans.workspace import Workspace

    with Workspace(spark) as workspace:
        yield workspace


@pytest.fixture
def small(spark):
    return f"{DATA}/sf0.001"


@pytest.fixture
def make_transfers(spark):
    """Transfers from (source, target[, amount[, minute]]) tuples."""
    from datetime import datetime, timedelta
    from decimal import Decimal

    from ledgerloop.schema import TRANSFER

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            source, target, amount, minute = (list(row) + [100, i][len(row) - 2 :])[:4]
            full.append(
                (
                    f"t{i:04d}",
                    source,
                    target,
                    Decimal(str(amount)),
                    datetime(2024, 1, 1) + timedelta(minutes=minute),
                    "ACH",
                    0,
                )
            )
        return spark.createDataFrame(full, TRANSFER)

    return build
