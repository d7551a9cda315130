"""Results do not depend on the session time zone (NTZ end to end)."""

import datetime as dt

import pytest

import __spark_entry__ as ent
from quayside.functions import timeparse as TP
from quayside.plans.verify import compare

from conftest import SMALL


@pytest.fixture
def la_session(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_inside_a_dst_gap(la_session):
    df = la_session.createDataFrame([("2024-03-10", "02:30")], "d string, t string")
    assert df.select(TP.hlcu_event_ts("d", "t").alias("x")).first().x == dt.datetime(2024, 3, 10, 2, 30)


@pytest.mark.parametrize("key", ["classify_tracking", "flag_latest_hlcu", "latest_file_per_carrier",
                                 "incremental_read", "parse_event_ts", "journey_timeline"])
def test_queries_match_oracle_in_another_zone(la_session, duck, key):
    ok, msg = compare(ent.queries()[key](la_session, SMALL), duck, ent.oracle_sql()[key])
    assert ok, f"{key}: {msg}"
