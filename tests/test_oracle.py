"""Every registered query against its SQL, once plainly and once with every skew path taken."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from orderloom.operators import timeline
from orderloom.workload.oracles import ORACLES
from orderloom.workload.queries import QUERIES
from tests.compare import connect, difference
from tests.conftest import SPREAD

SF_DIR = "/root/testdata/sf0.001"

# Queries whose plan depends on the skew settings.
SKEW_SENSITIVE = (
    "create_orders_bulk validate_legacy exists_in_registry resolve_customer migrate_legacy "
    "orders_append command_replay live_orders audit_rows update_outcomes status_transitions "
    "history_position customer_dim_ids sort_qty_desc delete_outcomes"
).split()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point_serves_them():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_equals_sql_under_skew_handling(spark, duck, settings, monkeypatch, name):
    settings(**SPREAD)
    monkeypatch.setattr(timeline, "TASK_ROWS", 0)
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None
