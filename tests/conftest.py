from __future__ import annotations

import pytest

from orderloom.session import local_session

# Chunks stay apart, nothing is broadcast by size.
SPREAD = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g", **{"spark.sql.shuffle.partitions": "5"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test and put the old values back."""
    before: dict[str, str | None] = {}

    def change(**options: str) -> None:
        for name, value in options.items():
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def spread(settings):
    settings(**SPREAD)


RAW = "pos bigint, order_code string, customer_name string, quantity string, status string"


@pytest.fixture
def feed(spark):
    """Build a raw feed from 4-tuples; positions follow the list."""

    def build(*rows):
        return spark.createDataFrame([(i, *row) for i, row in enumerate(rows, 1)], RAW)

    return build


@pytest.fixture
def registry(spark):
    def build(*codes):
        return spark.createDataFrame([(code,) for code in codes], "order_code string")

    return build
