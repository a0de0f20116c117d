"""I: dimension management."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import keys
from sedimenta.operators import scd, star
from sedimenta.operators.surrogate import KeyRanges, KeyTable
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise, scratch_path
from sedimenta.sources import entities

AS_OF = "2024-06-01"


@query("I1_date_dimension", expect("SELECT * FROM dim_date", "dim_date"))
def _(spark, sf):
    return warehouse.dim_date(spark, sf)


@query("I2_unknown_members", expect("""
SELECT 'customer' AS dimension, customer_sk AS sk, first_name || ' ' || last_name AS label FROM dim_customer
UNION ALL SELECT 'product', product_sk, product_name FROM dim_product
UNION ALL SELECT 'store', store_sk, store_name FROM dim_store""", "dim_customer", "dim_product", "dim_store"))
def _(spark, sf):
    # Seeding twice must not add the row twice.
    customers = star.ensure_unknown_member(warehouse.dim_customer(spark, sf), star.UNKNOWN_CUSTOMER, "customer_sk")
    label = F.concat_ws(" ", "first_name", "last_name")
    out = customers.select(F.lit("customer").alias("dimension"), F.col("customer_sk").alias("sk"), label.alias("label"))
    products = warehouse.dim_product(spark, sf).select(
        F.lit("product").alias("dimension"), F.col("product_sk").alias("sk"), F.col("product_name").alias("label")
    )
    stores = warehouse.dim_store(spark, sf).select(
        F.lit("store").alias("dimension"), F.col("store_sk").alias("sk"), F.col("store_name").alias("label")
    )
    return out.unionByName(products).unionByName(stores)


@query("I2_unknown_prescription", expect("""
SELECT CAST('0x' || substr(sha256(concat_ws('_', order_id, product_id, partner_id, line_number, quantity, unit_price, discount, tax)), 1, 15) AS BIGINT) AS prescription_sk,
       order_id AS prescription_id, category AS lens_type FROM items JOIN products USING (product_id)
UNION ALL SELECT -1, -1, 'Unknown'""", "items", "products"))
def _(spark, sf):
    return warehouse.dim_prescription(spark, sf)


def moves(spark, sf):
    """Staged changes: the destination of each customer's orders, several rows per customer."""
    return entities.order_headers(spark, sf).select(
        "customer_id", "order_id", "created_at",
        F.concat(F.lit("CITY_"), (F.col("order_id") % 25).cast("string")).alias("city"),
    )


_LATEST = """latest AS (SELECT customer_id, arg_max('CITY_' || CAST(order_id % 25 AS VARCHAR), (created_at, order_id)) AS city
  FROM headers GROUP BY customer_id)"""


@query("I3_scd1_overwrite", expect(", " + _LATEST + """
SELECT h.customer_id, h.version, coalesce(l.city, h.city) AS city, h.effective_date, h.is_current
FROM history h LEFT JOIN latest l ON h.customer_id = l.customer_id""", "headers", "history"))
def _(spark, sf):
    dim = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    dim = dim.select("customer_id", "version", "city", "effective_date", "is_current")
    return scd.overwrite(dim, moves(spark, sf), "customer_id", ["city"], ["created_at", "order_id"])


def _merged(spark, sf, detect: bool):
    dim = scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])
    dim = dim.select("customer_id", "city", "effective_date", "expiry_date", "is_current", "version")
    return scd.merge_history(
        materialise(dim, "dim"), moves(spark, sf), "customer_id", ["city"], AS_OF, ["created_at", "order_id"], detect_changes=detect
    )


_MERGED = """
SELECT t.customer_id, t.city, t.effective_date,
       CASE WHEN s.customer_id IS NOT NULL AND t.is_current = 1 THEN DATE '2024-06-01' ELSE t.expiry_date END AS expiry_date,
       CASE WHEN s.customer_id IS NOT NULL AND t.is_current = 1 THEN 0 ELSE t.is_current END AS is_current, t.version
FROM history t LEFT JOIN staged s ON t.customer_id = s.customer_id
UNION ALL
SELECT s.customer_id, s.city, DATE '2024-06-01', NULL, 1,
       coalesce((SELECT max(t.version) FROM history t WHERE t.customer_id = s.customer_id), 0) + 1 FROM staged s"""


@query("I4_scd2_merge", expect(", " + _LATEST + ", staged AS (SELECT * FROM latest)" + _MERGED, "headers", "history"))
def _(spark, sf):
    return _merged(spark, sf, detect=False)


@query("I4_scd2_merge_detecting_changes", expect(", " + _LATEST + """, staged AS (
  SELECT l.* FROM latest l WHERE NOT EXISTS (SELECT 1 FROM history t WHERE t.customer_id = l.customer_id AND t.is_current = 1
    AND t.city = l.city))""" + _MERGED, "headers", "history"))
def _(spark, sf):
    return _merged(spark, sf, detect=True)


@query("I5_scd2_rebuild", expect("SELECT * FROM history", "history"))
def rebuild(spark, sf):
    return scd.rebuild_history(warehouse.change_log(spark, sf), "customer_id", "effective_date", ["change_id"])


@query("I6_scd3_previous_value", expect("""
SELECT product_id, product_name, CASE WHEN brand <> 'Brand#1' AND category = 'SMALL' THEN 'COMPACT' ELSE category END AS category,
       CASE WHEN brand <> 'Brand#1' AND category = 'SMALL' THEN 'SMALL' END AS previous_category FROM products""", "products"))
def _(spark, sf):
    products = entities.products(spark, sf)
    dim = products.select("product_id", "product_name", "category", F.lit(None).cast("string").alias("previous_category"))
    # Every brand but one renames its SMALL products; the rest of the change set repeats known values.
    renamed = F.when(F.col("category") == "SMALL", "COMPACT").otherwise(F.col("category"))
    changes = products.where(F.col("brand") != "Brand#1").select("product_id", renamed.alias("category"))
    return scd.shift_previous(dim, changes, "product_id", "category", "previous_category", ["category"])


@query("I7_sequence_surrogate_key", expect("""
SELECT customer_id, row_number() OVER (ORDER BY customer_id)
  + (SELECT count(*) FROM customers WHERE balance >= 0) AS customer_sk
FROM customers WHERE balance < 0
UNION ALL SELECT customer_id, row_number() OVER (ORDER BY customer_id) FROM customers WHERE balance >= 0""", "customers"))
def _(spark, sf):
    # Each load reserves its range before it writes, so loads need not wait for each other.
    source = materialise(entities.customers(spark, sf).select("customer_id", "balance"), "members")
    ranges = KeyRanges(spark, scratch_path(spark, "ranges"))
    first = ranges.number(source.where(F.col("balance") >= 0).select("customer_id"), ["customer_id"], "customer_sk", "run1")
    second = ranges.number(source.where(F.col("balance") < 0).select("customer_id"), ["customer_id"], "customer_sk", "run2")
    return first.unionByName(second)


@query("I8_hash_surrogate_key", expect("""
SELECT customer_id, effective_date, substr(sha256(CAST(customer_id AS VARCHAR) || '_' || CAST(effective_date AS VARCHAR)), 1, 12) AS hash_sk,
       sha256(CAST(customer_id AS VARCHAR) || '_' || CAST(effective_date AS VARCHAR)) AS full_hash_sk
FROM change_log""", "change_log"))
def _(spark, sf):
    return warehouse.change_log(spark, sf).select(
        "customer_id", "effective_date",
        keys.hash_key("customer_id", "effective_date").alias("hash_sk"),
        keys.hash_key("customer_id", "effective_date", length=64).alias("full_hash_sk"),
    )


@query("I9_star_load", expect("""
SELECT order_id, customer_sk, product_sk, store_sk, date_key, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount_amount AS DOUBLE) AS discount_amount,
       CAST(net_amount AS DOUBLE) AS net_amount FROM facts""", "facts"))
def star_load(spark, sf):
    amounts = ["unit_price", "total_price", "discount_amount", "net_amount"]
    return warehouse.facts(spark, sf).withColumns({c: F.col(c).cast("double") for c in amounts})


def checked_customers(spark, sf, length=15):
    """The customer dimension with keys from a key table that two loads have filled."""
    dim = warehouse.dim_customer(spark, sf).where(F.col("customer_id") != -1).drop("customer_sk")
    table = KeyTable(spark, scratch_path(spark, "keys"), ["customer_id", "effective_date"], "customer_sk", length)
    table.assign(dim.where(F.col("customer_id") % 3 == 0), "run1")
    keys = table.assign(dim, "run2")
    return star.seeded(keys.join(dim, table.business).select("customer_sk", *dim.columns), star.UNKNOWN_CUSTOMER)


@query("I8_checked_keys", expect("SELECT customer_sk, customer_id, effective_date FROM dim_customer WHERE customer_id <> -1", "dim_customer"))
def _(spark, sf):
    return checked_customers(spark, sf).where(F.col("customer_id") != -1).select("customer_sk", "customer_id", "effective_date")


@query("I9_star_load_checked_keys", expect("""
SELECT order_id, customer_sk, date_key, quantity, CAST(net_amount AS DOUBLE) AS net_amount FROM facts""", "facts"))
def _(spark, sf):
    facts = star.load_facts(entities.order_items(spark, sf), entities.source_orders(spark, sf), customers=checked_customers(spark, sf))
    return facts.select("order_id", "customer_sk", "date_key", "quantity", F.col("net_amount").cast("double").alias("net_amount"))


@query("I9_star_load_new_orders_only", expect("""
SELECT order_id, count(*) AS lines FROM facts WHERE order_id NOT IN (SELECT order_id FROM items WHERE return_flag = 'R')
GROUP BY order_id""", "facts"))
def _(spark, sf):
    loaded = entities.order_items(spark, sf).where(F.col("return_flag") == "R")
    new = warehouse.facts(spark, sf, loaded=loaded)
    return new.groupBy("order_id").agg(F.count("*").alias("lines"))


@query("I10_scd2_validation", expect("""
, dim AS (SELECT customer_id, version, effective_date, expiry_date, is_current FROM history WHERE city <> 'CITY_7')
SELECT 'current_rows_per_key' AS check_name, count(*) AS violation_count FROM (SELECT customer_id FROM dim GROUP BY customer_id HAVING sum(is_current) <> 1)
UNION ALL SELECT 'version_range', count(*) FROM (SELECT customer_id FROM dim GROUP BY customer_id HAVING min(version) <> 1 OR max(version) <> count(*))
UNION ALL SELECT 'duplicate_versions', count(*) FROM (SELECT 1 FROM dim GROUP BY customer_id, version HAVING count(*) > 1)
UNION ALL SELECT 'gap_or_overlap', count(*) FROM (SELECT expiry_date, lead(effective_date) OVER (PARTITION BY customer_id ORDER BY version) AS nxt FROM dim)
  WHERE nxt IS NOT NULL AND expiry_date IS DISTINCT FROM nxt""", "history"))
def _(spark, sf):
    # Losing the versions of one city breaks histories in every way but duplicated versions.
    broken = rebuild(spark, sf).where(F.col("city") != "CITY_7")
    return scd.validate_history(broken, "customer_id")
