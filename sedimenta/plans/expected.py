"""SQL views shared by the expected results.

They restate the entity views independently of the DataFrame code, over the given tables.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": ((), """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 97 = 15 THEN 'invalid_email_format'
                    ELSE lower(replace(c_name, '#', '_')) || '@example.com' END AS email,
               '+91' || CAST(c_custkey + 9876500000 AS VARCHAR) AS phone,
               n_name AS city, r_name AS state, c_mktsegment AS segment, c_acctbal AS balance,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS TIMESTAMP) AS created_at,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS TIMESTAMP)
                 + to_hours(c_custkey % 48 + 1) AS updated_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "stores": ((), """
        SELECT CAST(n_nationkey AS BIGINT) AS store_id, 'Store ' || n_name AS store_name,
               n_name AS city, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "products": ((), """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
               p_retailprice AS price FROM part"""),
    "headers": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PROCESSING' ELSE 'PENDING' END AS order_status,
               o_totalprice AS total_amount, o_orderpriority AS priority, o_orderdate AS created_at,
               o_orderdate + to_hours(o_orderkey % 48 + 1) AS updated_at
        FROM orders"""),
    "source_orders": (("headers",), """
        SELECT order_id, customer_id, CAST(c_nationkey AS BIGINT) AS store_id, order_status,
               CASE WHEN c_acctbal < 0 THEN -total_amount ELSE total_amount END AS total_amount,
               created_at, updated_at
        FROM headers JOIN customer ON customer_id = c_custkey"""),
    "silver_orders": (("source_orders",), """
        SELECT *, CAST(created_at AS DATE) AS order_date FROM source_orders WHERE total_amount >= 0"""),
    "items": ((), """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS partner_id,
               CAST(l_linenumber AS BIGINT) AS line_number, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS unit_price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(l_tax AS DECIMAL(4,2)) AS tax, l_returnflag AS return_flag, l_linestatus AS line_status,
               l_shipdate AS ship_ts,
               CAST(CAST(l_quantity AS DECIMAL(5,0)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS total_price,
               CAST(CAST(l_quantity AS DECIMAL(5,0)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2))
                 * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount
        FROM lineitem"""),
    "dim_customer": (("customers",), """
        SELECT CAST('0x' || substr(sha256(CAST(customer_id AS VARCHAR) || '_2024-01-01'), 1, 15) AS BIGINT) AS customer_sk,
               customer_id, first_name, last_name, email, city, state, DATE '2024-01-01' AS effective_date,
               CAST(NULL AS DATE) AS expiry_date, 1 AS is_current, CAST(1 AS BIGINT) AS version
        FROM customers WHERE balance >= 0
        UNION ALL SELECT -1, -1, 'Unknown', 'Customer', 'unknown@domain.com', 'Unknown', 'Unknown',
               DATE '1900-01-01', NULL, 1, 1"""),
    "dim_product": (("products",), """
        SELECT CAST('0x' || substr(sha256(CAST(product_id AS VARCHAR) || '_2024-01-01'), 1, 15) AS BIGINT) AS product_sk,
               product_id, product_name, category, price AS current_price, CAST(NULL AS VARCHAR) AS previous_category,
               DATE '2024-01-01' AS effective_date, 1 AS is_current
        FROM products
        UNION ALL SELECT -1, -1, 'Unknown Product', 'Unknown', 0.0, NULL, DATE '1900-01-01', 1"""),
    "dim_store": (("stores",), """
        SELECT store_id + 1 AS store_sk, store_id, store_name, city, state FROM stores
        UNION ALL SELECT -1, -1, 'Unknown Store', 'Unknown', 'Unknown'"""),
    "dim_date": ((), """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
               dayname(d) AS day_of_week, dayname(d) AS day_name, CAST(month(d) AS INTEGER) AS month,
               monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT unnest(generate_series(
                (SELECT CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP) FROM orders),
                (SELECT CAST(date_trunc('year', max(o_orderdate)) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders),
                INTERVAL 1 DAY)) AS d)"""),
    "facts": (("source_orders", "items", "dim_customer", "dim_product", "dim_store"), """
        SELECT i.order_id, coalesce(c.customer_sk, -1) AS customer_sk, coalesce(p.product_sk, -1) AS product_sk,
               coalesce(s.store_sk, -1) AS store_sk, CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS date_key,
               i.quantity, i.unit_price, i.total_price, i.discount_amount, i.total_price - i.discount_amount AS net_amount
        FROM items i JOIN source_orders o ON i.order_id = o.order_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id AND c.is_current = 1
        LEFT JOIN dim_product p ON i.product_id = p.product_id AND p.is_current = 1
        LEFT JOIN dim_store s ON o.store_id = s.store_id"""),
    "daily": (("silver_orders",), """
        SELECT day AS summary_date, store_id, n AS total_orders, done AS successful_orders, CAST(earned AS DOUBLE) AS total_revenue,
               CAST(earned AS DOUBLE) / n AS avg_order_value
        FROM (SELECT order_date AS day, store_id, count(*) AS n, count(*) FILTER (order_status = 'DELIVERED') AS done,
                     coalesce(sum(CAST(total_amount AS DECIMAL(14,2))) FILTER (order_status = 'DELIVERED'), 0) AS earned
              FROM silver_orders GROUP BY ALL)"""),
    "customer_spend": (("facts", "dim_customer", "dim_date"), """
        WITH spent AS (
            SELECT customer_sk, count(*) AS lines, sum(net_amount) AS net, max(date_key) AS last_key FROM facts GROUP BY customer_sk)
        SELECT customer_id, concat_ws(' ', first_name, last_name) AS customer_name, city, lines AS total_orders, net AS total_spend,
               full_date AS last_order_date
        FROM spent JOIN dim_customer USING (customer_sk) JOIN dim_date ON date_key = last_key"""),
    "change_log": (("customers", "headers"), """
        SELECT customer_id, DATE '1900-01-01' AS effective_date, city, CAST(-1 AS BIGINT) AS change_id FROM customers
        UNION ALL
        SELECT customer_id, CAST(created_at AS DATE), arg_max('CITY_' || CAST(order_id % 25 AS VARCHAR), order_id), max(order_id)
        FROM headers GROUP BY 1, 2"""),
    "history": (("change_log",), """
        SELECT customer_id, city, change_id, effective_date,
               lead(effective_date) OVER w AS expiry_date, row_number() OVER w AS version,
               CASE WHEN lead(effective_date) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
        FROM change_log WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)"""),
    "audit": ((), """
        SELECT event_type AS pipeline_id, 'run_' || strftime(ts, '%Y%m%d') AS run_id, min(ts) AS start_time, max(ts) AS end_time,
               count(*) AS records_extracted,
               sum(CASE WHEN value BETWEEN 1 AND 200 THEN 1 ELSE 0 END)::BIGINT AS records_loaded,
               sum(CASE WHEN value < 1 THEN 1 ELSE 0 END)::BIGINT AS records_rejected,
               CASE WHEN sum(CASE WHEN value < 1 THEN 1 ELSE 0 END) * 100 > count(*) * 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status
        FROM events GROUP BY event_type, strftime(ts, '%Y%m%d')"""),
}


def expect(body: str, *views: str) -> str:
    """``body`` preceded by the views it uses, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in ordered) + "\n" + body
