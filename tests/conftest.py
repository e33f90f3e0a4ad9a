import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trolley.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, shuffle_partitions=4, driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def purchases(spark):
    """The small purchase table of the written goldens; the last row has a missing item."""
    rows = [("C1", "A", "T1", "2020-01-01 09:00:00", 2.0, 10.0), ("C1", "A", "T2", "2020-01-11 08:00:00", 1.0, 5.0),
            ("C1", "A", "T3", "2020-01-31 08:00:00", 1.0, 5.0), ("C1", "B", "T3", "2020-01-31 08:00:00", 4.0, 8.0),
            ("C2", "B", "T4", "2020-01-30 12:00:00", 1.0, 2.0), ("C2", None, "T5", "2020-01-30 12:00:00", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "customer_id string, item_id string, transaction_id string, InvoiceDate string, item_qty double, item_amt double")
    return df.withColumn("InvoiceDate", df["InvoiceDate"].cast("timestamp_ntz"))
