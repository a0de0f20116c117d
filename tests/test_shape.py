"""Plan checks: what must and must not appear in the physical plans."""

import re

import pytest

from sedimenta.plans import QUERIES, warehouse
from sedimenta.sources import entities

HEAVY = [
    "C1_inner_fact_dimension", "C2_left_with_unknown_member", "C4_orphan_rows", "C5_new_members_only",
    "C8_fan_out_diagnosis", "C9_aggregate_before_join", "C11_late_dimension_repoint", "C13_enforce_foreign_key",
    "D1_gold_daily_sales", "D2_gold_daily_store_sales", "D3_executive_kpi", "D4_customer_spend", "D6_prescription_trends",
    "D12_dense_snapshot", "D13_order_lifecycle", "E2_top_products_per_category", "E3_monthly_orders_lag_lead",
    "I4_scd2_merge", "I9_star_load", "A10_cdc_flat_events", "A11_cdc_envelopes", "A12_replace_rows", "A13_upsert_orders",
    "A14_upsert_aggregate", "A16_insert_if_absent", "J4_referential_integrity", "J14_golden_compare",
]
WINDOWS = ["E1_spend_ranks", "E4_running_revenue", "E5_monetary_dense_rank", "E6_prior_order_amount", "C10_point_in_time_lookup"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables no size estimate lets Spark broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", HEAVY)
def test_no_pairing_no_python_no_own_broadcast(spark, sf, no_broadcast, name):
    # The history of the merge query is itself a distributed window, which broadcasts its carry table.
    text = plan(QUERIES[name].build(spark, sf))
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in text
    if name != "I4_scd2_merge":
        assert "BroadcastHashJoin" not in text


@pytest.mark.parametrize("name", WINDOWS)
def test_windows_over_rows_are_bucketed(spark, sf, no_broadcast, name):
    """Every window that is not over the carry table is partitioned by the bucket first."""
    text = plan(QUERIES[name].build(spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    over_rows = [line for line in text.splitlines() if re.search(r"Window \[(row_number|rank|dense_rank|sum|lag|lead|last)", line)]
    assert any("windowspecdefinition(_bucket" in line for line in over_rows)
    for line in over_rows:
        carried = re.search(r"Window \[\w+\((_n|_s_|_d|_w|_last|_run_rank|_c_)", line)
        assert carried or "windowspecdefinition(_bucket" in line


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["A5_table_scan_projection"].build(spark, sf))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_watermark_filter_reaches_the_scan(spark, sf):
    from pyspark.sql import functions as F

    source = entities.events(spark, sf)
    text = plan(source.where(F.col("ts") > F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")))
    assert "GreaterThan(ts,2024-01-10" in text


def test_daily_sales_reads_only_what_it_needs(spark, sf):
    text = plan(QUERIES["D1_gold_daily_sales"].build(spark, sf))
    assert "o_orderpriority" not in text and "c_name" not in text


def test_top_n_limits_groups_before_the_shuffle(spark, sf):
    text = plan(QUERIES["E2_top_products_per_category"].build(spark, sf))
    assert text.count("WindowGroupLimit") == 2


def test_partition_pruning(spark, sf):
    profiles = {r["layout"]: r for r in QUERIES["M1_plan_profile"].build(spark, sf).collect()}
    assert "year" in profiles["by_month"]["partition_filters"]
    assert "GreaterThanOrEqual(created_at" in profiles["flat"]["pushed_filters"]


def test_z_order_narrows_both_columns(spark, sf):
    spans = {r["column_name"]: r["mean_span"] for r in QUERIES["M3_z_order_file_spans"].build(spark, sf).collect()}
    assert max(spans.values()) < 0.6


def test_facts_point_at_the_unknown_member(spark, sf):
    assert warehouse.facts(spark, sf).where("customer_sk = -1").count() > 0


def test_adaptive_execution_splits_a_hot_customer(spark, no_broadcast):
    """A fact-to-dimension join with a third of the facts at one customer, sized for the test."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000)
        facts = spark.range(0, 200_000, 1, 8).select(hot.alias("customer_id"), F.rand(1).alias("amount"))
        dim = spark.range(5000).select(F.col("id").alias("customer_id"), (F.col("id") * 7).alias("customer_sk"))
        joined = facts.join(dim, "customer_id", "left").groupBy("customer_sk").agg(F.count("*").alias("n"))
        assert joined.agg(F.sum("n")).first()[0] == 200_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_order_grain_from_a_stored_fact_table(spark, sf, rows):
    from sedimenta.operators import gold, star

    stores = warehouse.dim_store(spark, sf)
    stored = star.to_order_grain(warehouse.facts(spark, sf, "stores"))
    assert rows(gold.daily_store_sales(stored, stores)) == rows(QUERIES["D2_gold_daily_store_sales"].build(spark, sf))


def test_order_facts_shuffle_the_lines_once(spark, sf, no_broadcast):
    text = plan(warehouse.order_facts(spark, sf))
    assert text.count("Exchange hashpartitioning(order_id") == 2  # lines and orders, nothing between sum and join


def test_the_watermark_of_a_load_reaches_the_scan(spark, sf):
    """The load filters on a computed time; the scan sees what that implies for the stored one."""
    text = plan(entities.source_orders(spark, sf, after="1998-07-01 00:00:00", until="2000-01-01 00:00:00"))
    assert "GreaterThan(o_orderdate,1998-06-29T00:00" in text and "LessThan(o_orderdate,2000-01" in text
