"""The derived inputs contain the edge cases the rules must handle, so the
oracle comparisons exercise them (checked on sf0.01)."""

import pytest
from pyspark.sql import functions as F

from quayside import config as C
from quayside.plans import tracking as TR
from quayside.sources import standins as S
from quayside.sources.catalog import load_inputs

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    return load_inputs(spark, MID)


def test_event_edge_cases_present(t):
    ex = TR.hlcu_export(t)
    past = ex.filter(F.col("event_ts") <= F.lit(C.AS_OF))
    latest = past.groupBy("container_number").agg(F.max("event_ts").alias("m"))
    ties = past.join(latest, "container_number").filter(F.col("event_ts") == F.col("m")) \
        .groupBy("container_number").count().filter("count > 1")
    assert ties.count() > 0                                      # ties at the latest past event
    assert ex.filter(F.col("date") == "").count() > 0            # unparseable dates
    assert ex.filter(F.col("status").isNull()).count() > 0       # null statuses
    assert ex.filter(F.col("type_of_tracking") == C.FUTURE).count() > 0
    assert ex.filter(F.col("duplicates") == C.LATEST).count() > 0


def test_lookup_edge_cases_present(t):
    m = S.shipment_master(t)
    assert m.groupBy("sti").count().filter("count > 1").count() > 0        # first/last-wins matters
    assert m.filter(F.col("mbl") == "").count() > 0 and m.filter(F.col("mbl").isNull()).count() > 0
    cca = S.cca_sheet(t)
    assert cca.filter(F.col("cca") == " CCA ").count() > 0                  # padded marker
    y = S.yesterday(t)
    assert y.groupBy("lsc_tracking_number").count().filter("count > 1").count() > 0


def test_mixed_ids_cover_serial_bounds(t):
    ids = S.mixed_ids(t)
    assert ids.filter(F.col("id_number").isin(20000.0, 90000.0)).count() > 0
    assert ids.filter((F.col("id_number") > 20000) & (F.col("id_number") < 90000)).count() > 0
    assert ids.filter(F.col("id_text") == "45000").count() > 0


def test_cards_cover_not_found_and_case_variants(t):
    cards = S.tracking_cards(t)
    assert cards.filter(F.col("text").startswith("No results")).count() > 0
    assert cards.filter(F.col("text").contains("load on vessel")).count() > 0
