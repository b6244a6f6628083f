from __future__ import annotations

import datetime as dt
import io
import sys
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("purchaseflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def histories(spark):
    """Builds (id, key, item, d) rows from {key: "ABC"}, one day per item."""

    def build(items_by_key, start="2024-01-01"):
        day, rows = dt.date.fromisoformat(start), []
        for key, items in items_by_key.items():
            for offset, item in enumerate(items):
                rows.append((len(rows) + 1, key, item, day + dt.timedelta(days=offset)))
        return spark.createDataFrame(rows, "id int, key int, item string, d date")

    return build


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a DataFrame as text."""

    def text(df, mode="formatted"):
        out = io.StringIO()
        with redirect_stdout(out):
            df.explain(mode)
        return out.getvalue()

    return text
