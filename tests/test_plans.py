"""Plan-shape checks: the physical plans keep the scale properties the
operators are designed for."""

import io
import re
from contextlib import redirect_stdout

import pytest

from quayside.plans.registry import all_queries

from conftest import SMALL


def plan_of(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_of(q(spark, SMALL)) for k, q in sorted(all_queries().items())}


def test_no_cross_products_or_python_udfs(plans):
    bad = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
           "FlatMapGroupsInPandas", "MapInPandas")
    for k, p in plans.items():
        for op in bad:
            assert op not in p, f"{k} uses {op}"


@pytest.mark.parametrize("key", ["classify_tracking", "flag_latest_hlcu"])
def test_winner_picks_are_hash_aggregates_not_windows(plans, key):
    p = plans[key]
    assert "HashAggregate" in p
    assert not re.search(r"\(\d+\) Window\b", p)


def test_top_k_per_type_is_partial_window_group_limit(plans):
    assert len(re.findall(r"\(\d+\) WindowGroupLimit", plans["sample_per_type"])) >= 2


def test_incremental_read_pushes_watermark_to_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*last_updated", plans["incremental_read"])


def test_reference_tables_broadcast(plans):
    assert "BroadcastHashJoin" in plans["container_ref"]


def _logical(spark, name):
    return all_queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_queries_take_only_the_steps_they_select(spark):
    assert "Join" not in _logical(spark, "concat_keys_maeu")
    dup = _logical(spark, "dq_duplicate_events")
    assert "Join" not in dup and dup.count("Aggregate") == 1
    # "_win_ord" is the column that the classification and the flag join on
    assert "_win_ord" not in _logical(spark, "dim_containers")
    assert "_is_latest" not in _logical(spark, "fct_tracking_events")


def test_container_filter_stands_below_the_winner_picks(spark):
    """In the optimised plan every aggregate and join has the container filter
    beneath it."""
    lines = _logical(spark, "container_lookup").splitlines()
    scans = [k for k, line in enumerate(lines) if "Relation" in line]
    for k in scans:
        above = lines[:k]
        last_op = max(j for j, line in enumerate(above) if "Aggregate" in line or "Join" in line)
        assert any("CONT" in line and "Filter" in line for line in above[last_op:]), "\n".join(lines)


def test_tms_extract_reduces_branches_first(plans):
    p = plans["tms_extract"]
    assert "LeftSemi" in p


def _scan(df):
    """Rows that the scans of `df` put out, from their metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_stored_lookup_skips_row_groups(spark, tmp_path):
    from pyspark.sql import functions as F

    from quayside.operators import events as E

    path = str(tmp_path / "lookup")
    rows = spark.range(200_000).select(F.format_string("BOX%07d", F.col("id") * 2 % 40_000).alias("container_number"),
                                       (F.col("id") % 3).cast("string").alias("type_of_tracking"), F.sha2(F.col("id").cast("string"), 256).alias("rest"))
    E.write_lookup_snapshot(rows, path, row_group_bytes=256 << 10)
    one = E.stored_container_lookup(spark, path, "BOX0020000")
    assert "PushedFilters: [IsNotNull(container_number), EqualTo(container_number,BOX0020000)]" in plan_of(one)
    assert one.count() == 10
    assert 10 <= _scan(one) < 20_000  # of 200,000 rows
    # An absent value between two that exist: the bloom filters answer.
    assert _scan(E.stored_container_lookup(spark, path, "BOX0020001")) == 0
