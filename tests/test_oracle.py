"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as ent
from quayside.plans.oracle import SQL
from quayside.plans.registry import all_queries
from quayside.plans.verify import compare

from conftest import SMALL

KEYS = sorted(all_queries())


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(SQL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = all_queries()[key](spark, SMALL)
    ok, msg = compare(df, duck, SQL[key])
    assert ok, f"{key}: {msg}"


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["container_number", "carrier", "vessel_name", "pol", "pod", "latest_event_time",
                          "current_status"]
