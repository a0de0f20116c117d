"""C: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions.keys import number_key
from sedimenta.operators import audit, joins, routing, scd, star
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise
from sedimenta.sources import entities


@query("C1_inner_fact_dimension", expect("""
SELECT f.order_id, f.date_key, f.quantity, s.store_name, s.state FROM facts f JOIN dim_store s ON f.store_sk = s.store_sk""",
    "facts"))
def _(spark, sf):
    stores = warehouse.dim_store(spark, sf).select("store_sk", "store_name", "state")
    return warehouse.facts(spark, sf, "stores").join(stores, "store_sk").select(
        "order_id", "date_key", "quantity", "store_name", "state"
    )


@query("C2_left_with_unknown_member", expect("""
SELECT o.order_id, coalesce(c.customer_sk, -1) AS customer_sk
FROM headers o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""", "headers", "dim_customer"))
def _(spark, sf):
    customers = warehouse.dim_customer(spark, sf).select("customer_id", "customer_sk")
    return entities.order_headers(spark, sf).join(customers, "customer_id", "left").select(
        "order_id", star.or_unknown("customer_sk").alias("customer_sk")
    )


@query("C3_join_current_version", expect("""
SELECT o.order_id, h.city, h.version FROM headers o JOIN history h ON o.customer_id = h.customer_id AND h.is_current = 1""",
    "headers", "history"))
def _(spark, sf):
    history = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    current = history.where(F.col("is_current") == 1).select("customer_id", "city", "version")
    return entities.order_headers(spark, sf).join(current, "customer_id").select("order_id", "city", "version")


@query("C4_orphan_rows", expect("""
SELECT o.order_id, o.customer_id FROM headers o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
WHERE c.customer_id IS NULL""", "headers", "dim_customer"))
def _(spark, sf):
    known = warehouse.dim_customer(spark, sf).select("customer_id")
    return entities.order_headers(spark, sf).join(known, "customer_id", "left_anti").select("order_id", "customer_id")


@query("C5_new_members_only", expect("""
SELECT customer_id, email FROM customers WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer)""",
    "customers", "dim_customer"))
def _(spark, sf):
    dim = warehouse.dim_customer(spark, sf)
    return star.new_members(entities.customers(spark, sf), dim, "customer_id").select("customer_id", "email")


@query("C6_semi_join", expect("""
SELECT customer_id, city FROM customers WHERE customer_id IN (SELECT customer_id FROM headers WHERE priority = '1-URGENT')""",
    "customers", "headers"))
def _(spark, sf):
    urgent = entities.order_headers(spark, sf).where(F.col("priority") == "1-URGENT").select("customer_id")
    return entities.customers(spark, sf).join(urgent, "customer_id", "left_semi").select("customer_id", "city")


@query("C7_full_outer_reconciliation", expect("""
SELECT coalesce(a.order_id, b.order_id) AS order_id, CASE WHEN a.order_id IS NULL THEN 0 ELSE 1 END AS in_source,
       CASE WHEN b.order_id IS NULL THEN 0 ELSE 1 END AS in_target
FROM (SELECT order_id FROM source_orders WHERE total_amount >= 0) a
FULL OUTER JOIN (SELECT DISTINCT order_id FROM items) b ON a.order_id = b.order_id""", "source_orders", "items"))
def _(spark, sf):
    return audit.reconcile_keys(warehouse.silver_orders(spark, sf), entities.order_items(spark, sf), "order_id")


@query("C7_store_day_spine", expect("""
SELECT s.store_sk, CAST(d AS DATE) AS full_date FROM dim_store s,
  (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""",
    "dim_store"))
def _(spark, sf):
    days = entities.order_headers(spark, sf).agg(
        F.min(F.to_date("created_at")).alias("first_day"), F.max(F.to_date("created_at")).alias("last_day")
    )
    return star.store_days(warehouse.dim_store(spark, sf).select("store_sk"), days)


@query("C8_fan_out_diagnosis", expect("""
SELECT o.order_id, o.total_amount AS order_table_total, CAST(sum(i.total_price) AS DOUBLE) AS items_sum, count(*) AS item_count
FROM headers o JOIN items i ON o.order_id = i.order_id GROUP BY o.order_id, o.total_amount HAVING count(*) > 1""",
    "headers", "items"))
def _(spark, sf):
    return joins.fan_out(entities.order_headers(spark, sf), entities.order_items(spark, sf))


@query("C8_fan_out_effect", expect("""
SELECT (SELECT CAST(sum(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) FROM headers WHERE order_id IN (SELECT order_id FROM items)) AS true_total,
       CAST(sum(CAST(o.total_amount AS DECIMAL(14,2))) AS DOUBLE) AS inflated_total, count(*) AS joined_rows
FROM headers o JOIN items i ON o.order_id = i.order_id""", "headers", "items"))
def _(spark, sf):
    return joins.fan_out_effect(entities.order_headers(spark, sf), entities.order_items(spark, sf))


@query("C9_aggregate_before_join", expect("""
SELECT o.order_id, o.order_status, o.total_amount, i.item_count, CAST(i.items_sum AS DOUBLE) AS items_sum
FROM headers o JOIN (SELECT order_id, count(*) AS item_count, sum(total_price) AS items_sum FROM items GROUP BY order_id) i
ON o.order_id = i.order_id""", "headers", "items"))
def _(spark, sf):
    per_order = joins.items_per_order(entities.order_items(spark, sf))
    return entities.order_headers(spark, sf).join(per_order, "order_id").select(
        "order_id", "order_status", "total_amount", "item_count", F.col("items_sum").cast("double").alias("items_sum")
    )


@query("C10_point_in_time_lookup", expect("""
SELECT o.order_id, o.customer_id, o.created_at, h.city, h.version FROM headers o LEFT JOIN history h
ON o.customer_id = h.customer_id AND CAST(o.created_at AS DATE) >= h.effective_date
AND (h.expiry_date IS NULL OR CAST(o.created_at AS DATE) < h.expiry_date)""", "headers", "history"))
def _(spark, sf):
    history = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    orders = entities.order_headers(spark, sf).select("order_id", "customer_id", "created_at")
    return scd.as_of_lookup(orders, history, "customer_id", "created_at", ["city", "version"], ["order_id"])


@query("C11_late_dimension_repoint", expect("""
SELECT i.order_id, i.product_id, i.line_number, i.quantity,
       CAST('0x' || substr(sha256(CAST(o.customer_id AS VARCHAR) || '_2024-01-01'), 1, 15) AS BIGINT) AS customer_sk
FROM items i JOIN headers o ON i.order_id = o.order_id""", "items", "headers"))
def _(spark, sf):
    items = entities.order_items(spark, sf).select("order_id", "product_id", "line_number", "quantity")
    orders = entities.order_headers(spark, sf).select("order_id", "customer_id")
    first = warehouse.dim_customer(spark, sf).select("customer_id", "customer_sk")
    keyed = orders.join(first, "customer_id", "left").select("order_id", star.or_unknown("customer_sk").alias("customer_sk"))
    facts = materialise(items.join(keyed, "order_id"), "facts")  # a stored table, read twice
    return star.repoint_late(facts, orders, warehouse.dim_customer(spark, sf, everyone=True))


_LATE = """late AS (SELECT customer_id, DATE '1997-01-01' + CAST(customer_id % 730 AS INTEGER) AS effective_date, 'LATE_' || city AS city
  FROM customers WHERE balance < 3000),
logged AS (SELECT customer_id, effective_date, city FROM change_log ANTI JOIN late USING (customer_id, effective_date) UNION ALL SELECT * FROM late),
whole AS (SELECT *, lead(effective_date) OVER w AS expiry_date, row_number() OVER w AS version
  FROM logged WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date))"""


def back_dated(spark, sf):
    """The history before and after address changes that became known late, and the orders pointing at the former."""
    columns = ["customer_id", "city", "effective_date", "expiry_date", "is_current", "version"]
    sk = number_key("customer_id", "effective_date")
    history = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    before = materialise(history.select(sk.alias("customer_sk"), *columns), "history")
    since = F.date_add(F.lit("1997-01-01").cast("date"), (F.col("customer_id") % 730).cast("int"))
    late = entities.customers(spark, sf).where(F.col("balance") < 3000).select(
        "customer_id", since.alias("effective_date"), F.concat(F.lit("LATE_"), "city").alias("city"))
    late = late.withColumn("customer_sk", sk)
    after = scd.insert_versions(before, late, "customer_id", ["city"], "customer_sk", ["city"])
    orders = entities.order_headers(spark, sf).select("order_id", "customer_id", "created_at")
    facts = scd.as_of_lookup(orders, before, "customer_id", "created_at", ["customer_sk"], ["order_id"])
    return before, materialise(after, "history"), facts.select("order_id", "created_at", "customer_sk")


@query("C11_back_dated_version", expect(", " + _LATE + """
SELECT o.order_id, w.version, w.city,
       CAST('0x' || substr(sha256(CAST(w.customer_id AS VARCHAR) || '_' || CAST(w.effective_date AS VARCHAR)), 1, 15) AS BIGINT) AS customer_sk
FROM headers o JOIN whole w ON o.customer_id = w.customer_id AND CAST(o.created_at AS DATE) >= w.effective_date
  AND (w.expiry_date IS NULL OR CAST(o.created_at AS DATE) < w.expiry_date)""", "headers", "change_log"))
def _(spark, sf):
    before, after, facts = back_dated(spark, sf)
    repointed = star.repoint_back_dated(facts, before, after, "customer_id", "customer_sk", "created_at", ["order_id"])
    return repointed.join(after.select("customer_sk", "version", "city"), "customer_sk").select("order_id", "version", "city", "customer_sk")


@query("C11_back_dated_history_is_whole", expect(", " + _LATE + """
SELECT unnest(['current_rows_per_key', 'version_range', 'duplicate_versions', 'gap_or_overlap']) AS check_name, 0::BIGINT AS violation_count,
       (SELECT count(*) FROM whole) AS versions""", "change_log"))
def _(spark, sf):
    _before, after, _facts = back_dated(spark, sf)
    return scd.validate_history(after, "customer_id").withColumn("versions", F.lit(after.count()))


@query("C12_next_version_per_key", expect("""
SELECT c.customer_id, coalesce((SELECT max(h.version) FROM history h WHERE h.customer_id = c.customer_id), 0) + 1 AS version
FROM customers c""", "customers", "history"))
def _(spark, sf):
    history = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    staged = entities.customers(spark, sf).select("customer_id")
    return joins.next_versions(staged, history, "customer_id")


@query("C13_enforce_foreign_key", expect("""
SELECT o.order_id, CASE WHEN c.customer_id IS NULL THEN 'FK_VIOLATION' ELSE 'OK' END AS outcome
FROM headers o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""", "headers", "dim_customer"))
def _(spark, sf):
    orders = entities.order_headers(spark, sf).select("order_id", "customer_id")
    checked = routing.check_foreign_key(orders, warehouse.dim_customer(spark, sf), "customer_id", "customer_id")
    return checked.select("order_id", F.coalesce("reason_code", F.lit("OK")).alias("outcome"))


@query("C14_flatten_hierarchy", expect("""
SELECT c_custkey AS customer_id, n_name AS nation_name, r_name AS region_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""))
def _(spark, sf):
    return entities.customers(spark, sf).select(
        "customer_id", F.col("city").alias("nation_name"), F.col("state").alias("region_name")
    )
