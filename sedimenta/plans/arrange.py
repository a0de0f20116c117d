"""M: physical layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import footers, gold, layout
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise, scratch_path
from sedimenta.sources import entities
from sedimenta.sources.tables import PartitionedTable

Z_COLUMNS = ["customer_id", "total_amount"]


@query("M1_plan_profile")
def _(spark, sf):
    orders = entities.order_headers(spark, sf)
    flat, dated = scratch_path(spark, "flat"), scratch_path(spark, "dated")
    orders.write.parquet(flat)
    layout.write_by_month(orders, "created_at", dated)
    before = spark.read.parquet(flat).where(F.col("created_at") >= F.lit("2001-06-01 00:00:00").cast("timestamp_ntz"))
    after = spark.read.parquet(dated).where((F.col("year") == 2001) & (F.col("month") >= 6))
    return layout.plan_profile(before.select("order_id", "total_amount"), "flat").unionByName(
        layout.plan_profile(after.select("order_id", "total_amount"), "by_month")
    )


@query("M2_partitioned_layout", expect("""
SELECT order_id, total_amount, CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month FROM headers
WHERE year(created_at) = 2000 AND month(created_at) BETWEEN 4 AND 6""", "headers"))
def _(spark, sf):
    path = scratch_path(spark, "dated")
    layout.write_by_month(entities.order_headers(spark, sf), "created_at", path)
    second_quarter = (F.col("year") == 2000) & F.col("month").between(4, 6)
    return spark.read.parquet(path).where(second_quarter).select("order_id", "total_amount", "year", "month")


@query("M3_z_ordered_content", expect("SELECT order_id, customer_id, total_amount FROM headers", "headers"))
def _(spark, sf):
    path = scratch_path(spark, "clustered")
    orders = entities.order_headers(spark, sf).select("order_id", *Z_COLUMNS)
    layout.write_clustered(orders, Z_COLUMNS, path)
    return spark.read.parquet(path)


@query("M3_z_order_file_spans")
def _(spark, sf):
    path = scratch_path(spark, "clustered")
    layout.write_clustered(entities.order_headers(spark, sf).select("order_id", *Z_COLUMNS), Z_COLUMNS, path)
    return layout.cluster_overlap(spark.read.parquet(path), Z_COLUMNS)


def _skipping(spark, paths, ranges, wanted, columns):
    """Per layout: rows, wanted rows, whether footers and rows agree, and how much of the table a reader skips."""
    out = None
    for label, path in paths.items():
        stats = footers.statistics(spark, path)
        groups = materialise(footers.groups_in(stats, ranges), "groups")
        found = footers.recomputed(spark.read.parquet(path), groups, wanted, columns)
        named = [stats.where(F.col("column_name") == n).select("file", "row_group", F.col("low").alias(f"s_low_{n}"), F.col("high").alias(f"s_high_{n}"))
                 for n in columns]
        for bounds in named:
            found = found.join(bounds, ["file", "row_group"])
        agree = F.col("rows") == F.col("rows_found")
        for n in columns:
            agree = agree & (F.col(f"low_{n}") == F.col(f"s_low_{n}")) & (F.col(f"high_{n}") == F.col(f"s_high_{n}"))
        row = found.agg(
            F.sum("rows_found").alias("row_count"), F.sum("rows_wanted").alias("rows_wanted"),
            F.sum(F.when(~F.col("is_read"), F.col("rows_wanted")).otherwise(0)).alias("rows_missed"),
            F.count(F.when(~agree, 1)).alias("groups_disagreeing"),
            F.sum(F.when(F.col("is_read"), F.col("rows")).otherwise(0)).alias("rows_read"),
        ).select(F.lit(label).alias("layout"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _compared(report, plain, better):
    """The report with, in place of the rows read (which depend on the files), whether the better layout reads fewer."""
    report = materialise(report, "skipping")
    read = {r["layout"]: r["rows_read"] for r in report.collect()}
    return report.drop("rows_read").withColumn("reads_fewer", F.lit(int(read[better] < read[plain])))


@query("M1_groups_read", expect("""
SELECT unnest(['flat', 'by_month']) AS layout, (SELECT count(*) FROM headers) AS row_count,
       (SELECT count(*) FROM headers WHERE created_at >= TIMESTAMP '2001-06-01 00:00:00') AS rows_wanted,
       0::BIGINT AS rows_missed, 0::BIGINT AS groups_disagreeing, 1 AS reads_fewer""", "headers"))
def _(spark, sf):
    orders = entities.order_headers(spark, sf).select("order_id", "created_at", "total_amount")
    paths = {"flat": scratch_path(spark, "flat"), "by_month": scratch_path(spark, "dated")}
    orders.write.parquet(paths["flat"])
    layout.write_by_month(orders, "created_at", paths["by_month"])
    since = F.col("created_at") >= F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("created_at"))
    ranges = {"created_at": (991_353_600_000_000, None)}  # 2001-06-01
    return _compared(_skipping(spark, paths, ranges, since, {"created_at": at}), "flat", "by_month")


@query("M3_groups_skipped", expect("""
SELECT unnest(['as_written', 'clustered']) AS layout, (SELECT count(*) FROM headers) AS row_count,
       (SELECT count(*) FROM headers WHERE customer_id BETWEEN 20 AND 50 AND total_amount BETWEEN 100000 AND 200000) AS rows_wanted,
       0::BIGINT AS rows_missed, 0::BIGINT AS groups_disagreeing, 1 AS reads_fewer""", "headers"))
def _(spark, sf):
    orders = entities.order_headers(spark, sf).select("order_id", *Z_COLUMNS)
    paths = {"as_written": scratch_path(spark, "written"), "clustered": scratch_path(spark, "clustered")}
    orders.write.parquet(paths["as_written"])
    layout.write_clustered(orders, Z_COLUMNS, paths["clustered"])
    ranges = {"customer_id": (20, 50), "total_amount": (100_000, 200_000)}
    wanted = F.col("customer_id").between(20, 50) & F.col("total_amount").between(100_000, 200_000)
    return _compared(_skipping(spark, paths, ranges, wanted, {c: F.col(c) for c in Z_COLUMNS}), "as_written", "clustered")


@query("M4_summary_refresh", expect("""
SELECT summary_date, store_id, total_orders, successful_orders, total_revenue, avg_order_value,
       CAST(year(summary_date) AS INTEGER) AS year FROM daily""", "daily"))
def _(spark, sf):
    # The summary was built when deliveries after the cut were unknown; only those years are rebuilt.
    table = PartitionedTable(spark, scratch_path(spark, "summary"), "year")
    silver = warehouse.silver_orders(spark, sf)
    cut = F.lit("1999-07-01").cast("date")
    stale = silver.withColumn(
        "order_status", F.when(F.col("order_date") >= cut, "PENDING").otherwise(F.col("order_status"))
    )
    table.replace(_by_year(stale), "first")
    touched = silver.where(F.year("order_date") >= F.year(cut))
    return layout.refresh_groups(table, _by_year(touched), "refresh")


def _by_year(orders):
    return gold.daily_sales(orders).drop("avg_delivered_value").withColumn("year", F.year("summary_date"))
