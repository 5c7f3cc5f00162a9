from __future__ import annotations

import os
import sys
from datetime import date

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LOG_SCHEMA = (
    "user_id long, merchant_id long, item_id long, cat_id long, brand_id long, "
    "dt date, action_type string, seq1 long, seq2 long"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    """Log rows from (user, merchant, item, cat, brand, (month, day), action); seq in row order."""

    def build(rows):
        full = [
            (u, m, i, c, b, date(2016, *day) if day else None, a, n, 0)
            for n, (u, m, i, c, b, day, a) in enumerate(rows)
        ]
        return spark.createDataFrame(full, LOG_SCHEMA)

    return build


@pytest.fixture(scope="session")
def make_matrix(spark):
    def build(pairs):
        return spark.createDataFrame(
            [(u, m, "train", 1.0) for u, m in pairs],
            "user_id long, merchant_id long, origin string, label double",
        )

    return build
