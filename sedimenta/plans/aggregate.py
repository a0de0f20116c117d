"""D, E and F: aggregation, window functions, sorting and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions.money import money
from sedimenta.operators import audit, gold, ordered, quality, star
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise
from sedimenta.sources import entities


@query("D1_gold_daily_sales", expect("""
SELECT *, CASE WHEN successful_orders > 0 THEN total_revenue / CAST(successful_orders AS DOUBLE) END AS avg_delivered_value
FROM daily""", "daily"))
def daily_sales(spark, sf):
    return gold.daily_sales(warehouse.silver_orders(spark, sf))


@query("D2_gold_daily_store_sales", expect("""
SELECT f.date_key, f.store_sk, s.store_name, s.state, count(DISTINCT f.order_id) AS total_orders,
       CAST(sum(f.quantity) AS BIGINT) AS total_items_sold, CAST(sum(f.total_price) AS DOUBLE) AS gross_revenue,
       CAST(sum(f.net_amount) AS DOUBLE) AS net_revenue
FROM facts f JOIN dim_store s ON f.store_sk = s.store_sk GROUP BY ALL""", "facts"))
def daily_store_sales(spark, sf):
    return gold.daily_store_sales(warehouse.order_facts(spark, sf, "stores"), warehouse.dim_store(spark, sf))


@query("D3_executive_kpi", expect("""
SELECT d.year, d.month, d.month_name, count(DISTINCT f.order_id) AS total_orders, CAST(sum(f.quantity) AS BIGINT) AS total_units_sold,
       CAST(round(sum(f.total_price), 2) AS DOUBLE) AS gmv, CAST(round(sum(f.discount_amount), 2) AS DOUBLE) AS total_discounts,
       CAST(round(sum(f.net_amount), 2) AS DOUBLE) AS net_revenue,
       round(CAST(sum(f.net_amount) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS average_order_value,
       round(CAST(sum(f.net_amount) AS DOUBLE) / CAST(count(DISTINCT f.order_id) AS DOUBLE), 2) AS revenue_per_order
FROM facts f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month, d.month_name""", "facts", "dim_date"))
def executive_kpi(spark, sf):
    return gold.executive_kpi(warehouse.order_facts(spark, sf), warehouse.dim_date(spark, sf))


def spend(spark, sf):
    return gold.customer_spend(
        warehouse.order_facts(spark, sf, "customers"), warehouse.dim_customer(spark, sf), warehouse.dim_date(spark, sf)
    )


@query("D4_customer_spend", expect("""
SELECT customer_id, customer_name, city, total_orders, CAST(total_spend AS DOUBLE) AS total_spend, last_order_date
FROM customer_spend""", "customer_spend"))
def _(spark, sf):
    return spend(spark, sf).withColumn("total_spend", F.col("total_spend").cast("double"))


@query("D5_customer_lifetime", expect("""
SELECT customer_id, count(order_id) AS total_orders, CAST(sum(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) AS lifetime_spend,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM silver_orders GROUP BY customer_id""", "silver_orders"))
def _(spark, sf):
    return gold.customer_lifetime(warehouse.silver_orders(spark, sf))


@query("D6_prescription_trends", expect("""
SELECT c.state, p.category AS lens_type, count(*) AS total_prescriptions,
       round(CAST(sum(i.quantity) AS DOUBLE) / count(*), 2) AS avg_sphere_left,
       round(CAST(sum(i.discount) AS DOUBLE) / count(*), 2) AS avg_sphere_right,
       round(CAST(sum(i.tax) AS DOUBLE) / count(*), 2) AS avg_cylinder_left,
       round(CAST(sum(i.unit_price) AS DOUBLE) / count(*), 2) AS avg_cylinder_right
FROM items i JOIN headers o ON i.order_id = o.order_id JOIN products p ON i.product_id = p.product_id
JOIN dim_customer c ON o.customer_id = c.customer_id AND c.is_current = 1 GROUP BY c.state, p.category""",
    "items", "headers", "products", "dim_customer"))
def prescription_trends(spark, sf):
    return gold.prescription_trends(warehouse.prescriptions(spark, sf), warehouse.dim_customer(spark, sf))


@query("D7_having_count", expect("""
SELECT order_id, line_number, count(*) AS row_count FROM items GROUP BY order_id, line_number HAVING count(*) > 1""", "items"))
def _(spark, sf):
    return quality.duplicate_keys(entities.order_items(spark, sf), ["order_id", "line_number"])


@query("D8_rfm_aggregate", expect("""
SELECT customer_id, count(order_id) AS frequency, CAST(sum(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) AS monetary,
       max(order_date) AS recency_latest_date
FROM (SELECT * REPLACE (CASE WHEN order_status = 'PENDING' THEN NULL ELSE customer_id END AS customer_id) FROM silver_orders)
WHERE customer_id IS NOT NULL GROUP BY customer_id""", "silver_orders"))
def _(spark, sf):
    # Pending orders are not assigned to a customer yet.
    assigned = warehouse.silver_orders(spark, sf).withColumn(
        "customer_id", F.when(F.col("order_status") != "PENDING", F.col("customer_id"))
    )
    return gold.rfm(assigned).withColumn("monetary", F.col("monetary").cast("double"))


@query("D9_sla_kpi", expect("""
, per_load AS (
  SELECT pipeline_id, count(*) AS runs, count(*) FILTER (status = 'SUCCESS') AS good, sum(records_extracted)::BIGINT AS seen,
         sum(records_loaded)::BIGINT AS kept, sum(records_rejected)::BIGINT AS refused
  FROM audit GROUP BY pipeline_id)
SELECT pipeline_id, runs AS total_runs, good AS successful_runs, seen AS total_extracted, kept AS total_loaded, refused AS total_rejected,
       round(good * 100 / runs::DOUBLE, 2) AS success_rate_pct FROM per_load""", "audit"))
def _(spark, sf):
    return audit.kpi_report(warehouse.audit(spark, sf))


@query("D10_top_stores", expect("""
SELECT store_id, CAST(sum(CAST(total_revenue AS DECIMAL(14,2))) AS DOUBLE) AS gross_revenue FROM daily
GROUP BY store_id ORDER BY gross_revenue DESC, store_id LIMIT 3""", "daily"))
def _(spark, sf):
    return gold.top_stores(gold.daily_sales(warehouse.silver_orders(spark, sf)), 3)


@query("D11_daily_snapshot", expect("""
SELECT date_key, store_sk, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
       CAST(sum(total_price) AS DOUBLE) AS total_gross_revenue, CAST(sum(net_amount) AS DOUBLE) AS total_net_revenue
FROM facts GROUP BY date_key, store_sk""", "facts"))
def _(spark, sf):
    return star.daily_snapshot(warehouse.order_facts(spark, sf, "stores"))


@query("D12_dense_snapshot", expect("""
, spine AS (SELECT s.store_sk, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key FROM dim_store s,
  (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)),
snap AS (SELECT date_key, store_sk, count(DISTINCT order_id) AS n, CAST(sum(quantity) AS BIGINT) AS q,
  CAST(sum(total_price) AS DOUBLE) AS g, CAST(sum(net_amount) AS DOUBLE) AS r FROM facts GROUP BY date_key, store_sk)
SELECT spine.date_key, spine.store_sk, coalesce(n, 0) AS total_orders, coalesce(q, 0) AS total_items_sold,
       coalesce(g, 0.0) AS total_gross_revenue, coalesce(r, 0.0) AS total_net_revenue
FROM spine LEFT JOIN snap ON spine.date_key = snap.date_key AND spine.store_sk = snap.store_sk""", "facts"))
def _(spark, sf):
    days = entities.order_headers(spark, sf).agg(
        F.min(F.to_date("created_at")).alias("first_day"), F.max(F.to_date("created_at")).alias("last_day")
    )
    spine = star.store_days(warehouse.dim_store(spark, sf).select("store_sk"), days)
    return star.dense_snapshot(star.daily_snapshot(warehouse.order_facts(spark, sf, "stores")), spine)


@query("D13_order_lifecycle", expect("""
SELECT o.order_id, o.created_at AS order_placed_ts, min(CASE WHEN return_flag = 'N' THEN ship_ts END) AS order_assigned_ts,
       min(CASE WHEN return_flag = 'A' THEN ship_ts END) AS order_picked_ts,
       min(CASE WHEN return_flag = 'R' THEN ship_ts END) AS order_delivered_ts, max(partner_id) AS delivery_partner_id,
       CAST(date_sub('minute', o.created_at, min(CASE WHEN return_flag = 'R' THEN ship_ts END)) AS DOUBLE) AS delivery_duration_minutes,
       CASE WHEN date_sub('minute', o.created_at, min(CASE WHEN return_flag = 'R' THEN ship_ts END)) > 86400 THEN 0 ELSE 1 END AS is_on_time
FROM headers o LEFT JOIN items i ON o.order_id = i.order_id GROUP BY o.order_id, o.created_at""", "headers", "items"))
def _(spark, sf):
    flag = F.col("return_flag")
    milestones = entities.order_items(spark, sf).select(
        "order_id", "partner_id", F.col("ship_ts").alias("ts"),
        F.when(flag == "N", "ASSIGNED").when(flag == "A", "PICKED").otherwise("DELIVERED").alias("status"),
    )
    return star.lifecycle(entities.order_headers(spark, sf), milestones, limit_minutes=60 * 24 * 60)


def activity(spark, sf):
    """Attempts of users at topics, from the event stream."""
    kind = F.col("event_type")
    return entities.events(spark, sf).select(
        "user_id", F.day("ts").alias("lesson"), "event_id", "ts",
        F.when(kind == "purchase", "COMPLETED").when(kind == "signup", "NOT_STARTED").otherwise("IN_PROGRESS").alias("status"),
        F.col("value").alias("score"),
        F.when(kind == "error", "joins, windows").when(kind == "click", "cdc").otherwise("").alias("weak_topics"),
    )


_ACTIVITY = """
, activity AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS lesson, event_id, ts, value AS score,
  CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'signup' THEN 'NOT_STARTED' ELSE 'IN_PROGRESS' END AS status,
  CASE event_type WHEN 'error' THEN 'joins, windows' WHEN 'click' THEN 'cdc' ELSE '' END AS weak_topics FROM events),
rollup_ AS (SELECT user_id, lesson, count(*) AS attempts, max(score) AS score, arg_max(status, (ts, event_id)) AS status,
  arg_max(weak_topics, (ts, event_id)) AS weak_topics FROM activity GROUP BY user_id, lesson)
"""


@query("D14_activity_rollup", "WITH " + _ACTIVITY.strip()[1:] + "SELECT * FROM rollup_")
def _(spark, sf):
    return gold.activity_rollup(activity(spark, sf), ["user_id", "lesson"])


@query("D14_activity_summary", "WITH " + _ACTIVITY.strip()[1:] + """
SELECT count(*) AS total_completed, CAST(sum(CAST(score AS DECIMAL(14,2))) AS DOUBLE) AS total_score,
       CAST(sum(CAST(score AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS avg_score FROM rollup_ WHERE status = 'COMPLETED'""")
def _(spark, sf):
    return gold.activity_summary(gold.activity_rollup(activity(spark, sf), ["user_id", "lesson"]))


@query("D14_weak_topics", "WITH " + _ACTIVITY.strip()[1:] + """
SELECT topic, count(*) AS key_count FROM (SELECT trim(unnest(string_split(weak_topics, ','))) AS topic FROM rollup_)
WHERE topic <> '' GROUP BY topic""")
def _(spark, sf):
    return gold.weak_topics(gold.activity_rollup(activity(spark, sf), ["user_id", "lesson"]))


@query("D15_layer_counts", expect("""
SELECT 'bronze' AS layer, count(*) AS row_count FROM source_orders UNION ALL SELECT 'silver', count(*) FROM silver_orders
UNION ALL SELECT 'gold', count(*) FROM daily""", "daily"))
def _(spark, sf):
    silver = warehouse.silver_orders(spark, sf)
    return gold.layer_counts({
        "bronze": entities.source_orders(spark, sf), "silver": silver, "gold": gold.daily_sales(silver)
    })


@query("E1_spend_ranks", expect("""
, above AS (  -- how many customers, and how many different amounts, lie above an amount
  SELECT amount, coalesce(sum(holders) OVER higher, 0) AS richer, row_number() OVER (ORDER BY amount DESC) AS place
  FROM (SELECT total_spend AS amount, count(*) AS holders FROM customer_spend GROUP BY total_spend)
  WINDOW higher AS (ORDER BY amount DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
placed AS (
  SELECT s.*, CAST(richer AS BIGINT) + row_number() OVER (PARTITION BY total_spend ORDER BY customer_id) AS n, CAST(richer AS BIGINT) + 1 AS tied, place
  FROM customer_spend s JOIN above ON amount = total_spend),
quarters AS (SELECT count(*) // 4 AS least, count(*) % 4 AS longer FROM customer_spend)
SELECT customer_id, customer_name, city, total_orders, CAST(total_spend AS DOUBLE) AS total_spend, last_order_date,
       n AS spend_row_num, tied AS spend_rank, place AS spend_dense_rank,
       CASE WHEN n <= longer * (least + 1) THEN (n - 1) // (least + 1) ELSE longer + (n - longer * (least + 1) - 1) // least END + 1 AS spend_quartile
FROM placed, quarters""", "customer_spend"))
def spend_ranks(spark, sf):
    return ordered.ordered_window(
        materialise(spend(spark, sf), "customer-spend"),
        {"spend_row_num": ordered.row_number(), "spend_rank": ordered.rank(),
         "spend_dense_rank": ordered.dense_rank(), "spend_quartile": ordered.ntile(4)},
        order_by=[("total_spend", "desc")], tiebreak=["customer_id"],
    ).withColumn("total_spend", F.col("total_spend").cast("double"))


@query("E2_top_products_per_category", expect("""
, sold AS (SELECT product_sk, sum(quantity) AS quantity FROM facts GROUP BY product_sk),
named AS (
  SELECT category, product_name, CAST(sum(quantity) AS BIGINT) AS total_qty FROM sold JOIN dim_product USING (product_sk) GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_qty DESC, product_name) AS rnk FROM named QUALIFY rnk <= 3""", "facts"))
def top_products(spark, sf):
    return gold.top_products(warehouse.facts(spark, sf, "products"), warehouse.dim_product(spark, sf), 3)


@query("E3_monthly_orders_lag_lead", expect("""
SELECT customer_sk, order_month, month_orders, lag(month_orders) OVER w AS prev_month_orders, lead(month_orders) OVER w AS next_month_orders
FROM (SELECT customer_sk, date_key // 100 AS order_month, count(DISTINCT order_id) AS month_orders FROM facts
      WHERE customer_sk <> -1 GROUP BY ALL)
WINDOW w AS (PARTITION BY customer_sk ORDER BY order_month)""", "facts"))
def monthly_orders(spark, sf):
    return gold.monthly_orders(warehouse.order_facts(spark, sf, "customers"))


@query("E4_running_revenue", expect("""
SELECT date_key, CAST(daily_net AS DOUBLE) AS daily_net,
       CAST(sum(daily_net) OVER (ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM (SELECT date_key, sum(net_amount) AS daily_net FROM facts GROUP BY date_key)""", "facts"))
def running_revenue(spark, sf):
    daily = warehouse.order_facts(spark, sf).groupBy("date_key").agg(F.sum("net_amount").alias("daily_net"))
    return ordered.ordered_window(
        materialise(daily, "daily-net"), {"running_total": ordered.running_sum("daily_net")},
        order_by=[("date_key", "asc")], tiebreak=[],
    ).select("date_key", *[F.col(c).cast("double").alias(c) for c in ("daily_net", "running_total")])


@query("E5_monetary_dense_rank", expect("""
SELECT customer_id, frequency, CAST(monetary AS DOUBLE) AS monetary, recency_latest_date,
       dense_rank() OVER (ORDER BY monetary DESC) AS monetary_rank
FROM (SELECT customer_id, count(order_id) AS frequency, sum(CAST(total_amount AS DECIMAL(14,2))) AS monetary,
             max(order_date) AS recency_latest_date FROM silver_orders GROUP BY customer_id)""", "silver_orders"))
def _(spark, sf):
    return ordered.ordered_window(
        materialise(gold.rfm(warehouse.silver_orders(spark, sf)), "rfm"), {"monetary_rank": ordered.dense_rank()},
        order_by=[("monetary", "desc")], tiebreak=["customer_id"],
    ).withColumn("monetary", F.col("monetary").cast("double"))


@query("E6_city_spend_row_number", expect("""
SELECT customer_id, city, CAST(total_spend AS DOUBLE) AS total_spend,
       row_number() OVER (PARTITION BY city ORDER BY total_spend DESC, customer_id) AS city_spend_row FROM customer_spend""",
    "customer_spend"))
def _(spark, sf):
    rows = spend(spark, sf).select("customer_id", "city", "total_spend")
    return ordered.ordered_window(
        materialise(rows, "city-spend"), {"city_spend_row": ordered.row_number()},
        partition_by=["city"], order_by=[("total_spend", "desc")], tiebreak=["customer_id"],
    ).withColumn("total_spend", F.col("total_spend").cast("double"))


@query("E6_prior_order_amount", expect("""
SELECT order_id, customer_id, total_amount, lag(total_amount) OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS prior_amount
FROM headers""", "headers"))
def _(spark, sf):
    rows = entities.order_headers(spark, sf).select("order_id", "customer_id", "total_amount", "created_at")
    return ordered.ordered_window(
        rows, {"prior_amount": ordered.lag("total_amount")},
        partition_by=["customer_id"], order_by=[("created_at", "asc")], tiebreak=["order_id"],
    ).drop("created_at")


@query("E6_latest_orders_per_customer", expect("""
SELECT order_id, customer_id, created_at, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, priority DESC, order_id) AS recency
FROM headers""", "headers"))
def _(spark, sf):
    rows = entities.order_headers(spark, sf).select("order_id", "customer_id", "priority", "created_at")
    return ordered.ordered_window(
        rows, {"recency": ordered.row_number()},
        partition_by=["customer_id"], order_by=[("created_at", "desc"), ("priority", "desc")], tiebreak=["order_id"],
    ).drop("priority")


@query("F1_sort_by_aggregate", expect("""
SELECT store_id, order_status, count(*) AS order_count, CAST(sum(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) AS amount
FROM source_orders GROUP BY ALL ORDER BY amount DESC, store_id, order_status""", "source_orders"))
def _(spark, sf):
    return entities.source_orders(spark, sf).groupBy("store_id", "order_status").agg(
        F.count("*").alias("order_count"), F.sum(money("total_amount")).cast("double").alias("amount")
    ).orderBy(F.desc("amount"), "store_id", "order_status")


@query("F3_top_k_orders", expect("""
SELECT order_id, total_amount FROM headers ORDER BY total_amount DESC, order_id LIMIT 10""", "headers"))
def _(spark, sf):
    return entities.order_headers(spark, sf).select("order_id", "total_amount").orderBy(F.desc("total_amount"), "order_id").limit(10)


@query("F4_running_revenue_sample", expect("""
SELECT date_key, CAST(daily_net AS DOUBLE) AS daily_net,
       CAST(sum(daily_net) OVER (ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM (SELECT date_key, sum(net_amount) AS daily_net FROM facts GROUP BY date_key) ORDER BY date_key LIMIT 5""", "facts"))
def _(spark, sf):
    return running_revenue(spark, sf).orderBy("date_key").limit(5)


@query("F4_lag_lead_sample", expect("""
SELECT customer_sk, order_month, month_orders, lag(month_orders) OVER w AS prev_month_orders, lead(month_orders) OVER w AS next_month_orders
FROM (SELECT customer_sk, date_key // 100 AS order_month, count(DISTINCT order_id) AS month_orders FROM facts
      WHERE customer_sk <> -1 GROUP BY ALL)
WINDOW w AS (PARTITION BY customer_sk ORDER BY order_month) ORDER BY customer_sk, order_month LIMIT 5""", "facts"))
def _(spark, sf):
    return monthly_orders(spark, sf).orderBy("customer_sk", "order_month").limit(5)


@query("F5_union_all", """
SELECT 'orders' AS source, o_orderkey AS record_id, o_totalprice AS amount FROM orders
UNION ALL SELECT 'events', event_id, value FROM events""")
def _(spark, sf):
    orders = entities.order_headers(spark, sf).select(
        F.lit("orders").alias("source"), F.col("order_id").alias("record_id"), F.col("total_amount").alias("amount")
    )
    return orders.unionByName(entities.events(spark, sf).select(
        F.col("value").alias("amount"), F.col("event_id").alias("record_id"), F.lit("events").alias("source")
    ))
