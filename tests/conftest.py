from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from buyerlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


ENRICHED = (
    "customer_unique_id string, order_id string, order_item_id int, order_purchase_timestamp timestamp, "
    "price double, freight_value double, payment_value_total double, payment_installments_avg double, "
    "payment_type_mode string, customer_state string"
)


@pytest.fixture(scope="session")
def basic_enriched(spark):
    return spark.createDataFrame([
        ("u1", "o1", 1, at("2018-06-01"), 100.0, 10.0, 110.0, 1.0, "credit_card", "SP"),
        ("u1", "o2", 1, at("2018-08-01"), 50.0, 5.0, 55.0, 2.0, "boleto", "SP"),
        ("u2", "o3", 1, at("2018-07-15"), 80.0, 8.0, 88.0, 1.0, "boleto", "RJ"),
    ], ENRICHED)


@pytest.fixture(scope="session")
def toy_features(spark):
    """90 customers in three separated blocks."""
    from buyerlens.contracts import CUSTOMER_FEATURES

    rows = []
    for i in range(90):
        block, j = divmod(i, 30)
        recency, frequency, monetary, score = (
            (5 + j % 15, 3 + j % 3, 300.0 + 17 * j, 5), (40 + j, 2, 80.0 + 4 * j, 3), (120 + 2 * j, 1, 20.0 + j, 1),
        )[block]
        rows.append((
            f"c{i:03d}", "2018-08-31", recency, frequency, monetary, score, score, score, f"{score}" * 3,
            monetary / frequency, 1.0 + block % 2, 10.0, 2.0, "boleto", "SP", 30 * (frequency - 1),
            float(30) if frequency > 1 else None, at("2018-01-01"), at("2018-08-01"), "1.0.0", at("2018-09-01"),
        ))
    return spark.createDataFrame(rows, CUSTOMER_FEATURES.schema).cache()
