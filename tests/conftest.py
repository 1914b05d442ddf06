from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from typed import SUBSCRIPTION_TYPES  # noqa: E402

from tenure.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tenure-tests", "local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def interpreted_plans(request, spark):
    """Tiny inputs: skip code generation, except where whole queries are compared."""
    generate = request.module.__name__ == "test_entry"
    spark.conf.set("spark.sql.codegen.wholeStage", str(generate).lower())
    spark.conf.set("spark.sql.shuffle.partitions", "8" if generate else "3")


def day(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


@pytest.fixture(scope="session")
def subs(spark):
    """(customer, start, end, price) tuples -> typed subscriptions in row order."""

    def build(*rows):
        typed = [
            (i, c, day(s), day(e), "basic", Decimal(str(p)))
            for i, (c, s, e, p) in enumerate(rows)
        ]
        return spark.createDataFrame(typed, SUBSCRIPTION_TYPES)

    return build


@pytest.fixture(scope="session")
def customers(spark):
    """(customer, signup) tuples -> typed customers."""

    def build(*rows):
        typed = [(i, c, day(s), "NL") for i, (c, s) in enumerate(rows)]
        return spark.createDataFrame(typed, "row_id BIGINT, customer_id STRING, signup_date DATE, country STRING")

    return build


@pytest.fixture(scope="session")
def raw_customers(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)],
            "row_id BIGINT, customer_id STRING, signup_date STRING, country STRING",
        )

    return build


@pytest.fixture(scope="session")
def raw_subs(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)],
            "row_id BIGINT, customer_id STRING, start_date STRING, end_date STRING, plan STRING, monthly_price STRING",
        )

    return build


@pytest.fixture(scope="session")
def ids(spark):
    def build(*names):
        return spark.createDataFrame([(n,) for n in names], "customer_id STRING")

    return build
