"""Scale properties of the physical plans, pinned so they cannot regress:
pruned scans, map-side partial aggregation before shuffles, no sort-merge join
in the reconciliation, and no unpartitioned window over fact-sized data."""

import re

import pytest

from conftest import SF_SMALL
from tallyhouse import catalog
from tallyhouse.plans.report import node_blocks, plan_text, summarize

HEADLINE = ["revenue_reconciliation", "orders_deduplicated", "products_resolved", "dim_date",
            "fact_order_lines", "fact_settlements", "daily_revenue", "revenue_by_category",
            "duplicate_orders", "late_refunds", "nightly_gate"]


@pytest.fixture(scope="module")
def plans(spark):
    q = catalog.queries()
    return {n: plan_text(q[n](spark, SF_SMALL)) for n in HEADLINE}


def windows(text):
    """(partition spec, arguments) of each Window node."""
    out = []
    for name, body in node_blocks(text):
        if name.startswith("Window"):
            args = re.search(r"Arguments: (.*)", body).group(1)
            part = re.search(r"\], \[(.*?)\], \[", args)
            out.append((part.group(1) if part else "", args))
    return out


@pytest.mark.parametrize("name", HEADLINE)
def test_scans_are_pruned(spark, name):
    s = summarize(catalog.queries()[name](spark, SF_SMALL))
    assert s["max_scan_columns"] <= 5, s


def test_dedup_aggregates_map_side(plans):
    assert "partial_min_by" in plans["orders_deduplicated"]
    assert "partial_min_by" in plans["products_resolved"]


def test_reconciliation_is_one_global_aggregation(plans):
    text = plans["revenue_reconciliation"]
    assert "SortMergeJoin" not in text
    assert not windows(text)


@pytest.mark.parametrize("name", ["fact_order_lines", "fact_settlements"])
def test_fact_keys_never_number_the_whole_fact_in_one_task(plans, name):
    w = windows(plans[name])
    partitioned = [a for p, a in w if p]
    unpartitioned = [a for p, a in w if not p]
    # rows are numbered inside (date, bucket) partitions ...
    assert partitioned and all("_b" in a and "_d" in a for a in partitioned)
    # ... and the only global window is the running sum over the small
    # (date, bucket) count table
    assert len(unpartitioned) == 1 and "_bn" in unpartitioned[0]


def test_only_bounded_windows_are_unpartitioned(plans):
    for name in ("daily_revenue", "revenue_by_category", "duplicate_orders", "late_refunds"):
        assert not windows(plans[name]), name
    # nightly gate: one running window over nights (bounded by the calendar)
    w = windows(plans["nightly_gate"])
    assert len(w) == 1 and w[0][0] == ""


def test_checks_read_few_tables_and_use_the_counts_of_the_build(spark):
    from tallyhouse.operators import checks as chk
    from tallyhouse.plans import jobs, registry
    from tallyhouse.plans.models import Models
    from tallyhouse.sources.tables import adapter_raw
    from pyspark.sql import functions as F
    built = registry._built(Models(adapter_raw(spark, SF_SMALL)), spark)
    assert built.metrics["fact_order_lines"]["rows"] == built.fact_order_lines.count()
    assert set(built.metrics) == set(jobs.BUILT_TABLES) and built.metrics["pos_classified"]["line_type"] == 0
    for df in (chk.check_results(chk.gate_checks(built, registry.DATA_CATEGORIES)), chk.model_assertions(built)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert 0 < plan.count("FileScan parquet") < 20
    # Rows that break a rule are counted while they are written, and then found by the check.
    lines = built.pos_classified.withColumn("line_type", F.when(F.col("quantity") > 1, "odd").otherwise(F.col("line_type")))
    from tallyhouse.session import scratch_path
    path = scratch_path(spark, "odd")
    counted = jobs._write_all(spark, {"pos_classified": lines}, {"pos_classified": path})
    assert counted["pos_classified"]["line_type"] == lines.where("line_type = 'odd'").count() > 0
    built.metrics |= counted
    built.pos_classified = spark.read.parquet(path)
    failing = {r.check_name: r.failing_rows for r in
               chk.check_results(chk.gate_checks(built, registry.DATA_CATEGORIES)).collect() if r.failing_rows}
    assert failing == {"accepted_values:pos_classified.line_type": 1}
