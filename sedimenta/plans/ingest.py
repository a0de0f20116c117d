"""A: sources, sinks and load patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions.money import sum_money
from sedimenta.operators import audit, cdc, gold, ingest, layout, merge, ordered, routing, vault
from sedimenta.operators.incremental import incremental_load
from sedimenta.plans import landing, warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise, scratch_path
from sedimenta.sources import entities, formats, readers
from sedimenta.sources.config import read_config
from sedimenta.sources.tables import LandingTable, PartitionedTable, VersionedTable, WatermarkControl
from sedimenta.streaming import sinks

CUT = "1998-07-01 00:00:00"
RUN_TS = "2024-06-01 00:00:00"
#: Serves the checks only; a deployment passes its own secret.
PEPPER = "check-pepper"


@query("A1_csv_scan", expect("SELECT * FROM customers", "customers"))
def _(spark, sf):
    return landing.landed_csv(spark, entities.customers(spark, sf))


@query("A2_json_document_scan", "SELECT event_id, user_id, event_type, value, ts FROM events")
def _(spark, sf):
    return landing.typed(landing.landed_documents(spark, landing.app_events(spark, sf), "event_id"))


@query("A3_ndjson_scan", "SELECT event_id, user_id, event_type, value, ts FROM events")
def _(spark, sf):
    events = landing.app_events(spark, sf)
    return landing.typed(readers.ndjson_table(spark, landing.landed_ndjson(spark, events), events.schema))


_PAYMENTS = """payments AS (SELECT 'pay_' || CAST(o_orderkey AS VARCHAR) AS payment_id, o_orderkey AS order_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'UPI' ELSE 'CARD' END AS payment_method,
  CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status, o_totalprice AS amount,
  right(lpad(CAST(o_custkey AS VARCHAR), greatest(4, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0'), 4) AS card_last4,
  o_orderdate AS created_at FROM orders)"""


@query("A4_paged_payload_flatten", "WITH " + _PAYMENTS + " SELECT *, order_id // 50 + 1 AS page FROM payments")
def _(spark, sf):
    return readers.page_records(landing.landed_pages(spark, sf))


@query("A4_page_completeness", """
SELECT max(o_orderkey) // 50 + 1 AS pages_landed, max(o_orderkey) // 50 + 1 AS pages_announced, count(*) AS records, 1 AS is_complete FROM orders""")
def _(spark, sf):
    return readers.page_completeness(landing.landed_pages(spark, sf))


@query("A4_silver_payments", "WITH " + _PAYMENTS + """
SELECT payment_id, order_id, payment_method, payment_status, amount FROM payments""")
def _(spark, sf):
    # A page fetched twice delivers its payments twice; the key removes them, the card digits stay in bronze.
    bronze = readers.page_records(landing.landed_pages(spark, sf))
    fetched = bronze.unionByName(bronze.where(F.col("payment_status") == "FAILED"))
    silver = merge.latest_per_key(fetched.where(F.col("amount") >= 0), ["payment_id"], ["created_at", "page"])
    return vault.minimise(silver, ["payment_id", "order_id", "payment_method", "payment_status", "amount"])


@query("A5_table_scan_projection", """
SELECT o_orderkey AS order_id, o_totalprice AS total_amount FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'""")
def _(spark, sf):
    recent = F.col("o_orderdate") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return readers.table(spark, sf, "orders").where(recent).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_amount")
    )


@query("A6_format_round_trip", """
SELECT unnest(['csv', 'json', 'parquet']) AS format, (SELECT count(*) FROM orders) AS row_count, 0::BIGINT AS differing_rows""")
def _(spark, sf):
    orders = entities.order_headers(spark, sf)
    return formats.conversion_report(orders, formats.convert(orders, scratch_path(spark, "formats")))


@query("A6_format_sizes")
def _(spark, sf):
    root = scratch_path(spark, "formats")
    paths = formats.convert(entities.order_headers(spark, sf), root)
    return formats.size_report(spark, root, tuple(paths))


@query("A7_append_only", expect("""
SELECT order_id, total_amount FROM headers WHERE created_at < TIMESTAMP '1998-07-01 00:00:00'
UNION ALL SELECT order_id, total_amount FROM headers WHERE created_at >= TIMESTAMP '1998-01-01 00:00:00'""", "headers"))
def _(spark, sf):
    # Two overlapping batches: the overlap is stored twice, as appending does.
    path = scratch_path(spark, "appended")
    orders = entities.order_headers(spark, sf)
    old = orders.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    new = orders.where(F.col("created_at") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    for batch in (old, new):
        batch.select("order_id", "total_amount").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def two_incremental_runs(spark, sf, **options):
    """A first run when the source ended at the cut, a second one over the grown source."""
    root = scratch_path(spark, "incremental")
    target, control = LandingTable(spark, f"{root}/orders"), WatermarkControl(spark, root)

    def source(after, until):
        return entities.source_orders(spark, sf, after, until)

    def early(after, until):
        return source(after, CUT).where(F.col("updated_at") <= F.lit(CUT).cast("timestamp_ntz"))

    reason = F.when(F.col("total_amount") < 0, "NEGATIVE_AMOUNT")
    results = [
        incremental_load(frame, target, control, pipeline_id="p002", run_id=run_id, watermark_column="updated_at",
                         reason=reason, **options)
        for frame, run_id in ((early, "run1"), (source, "run2"))
    ]
    return target, control, results


@query("A8_incremental_rows", expect("""
SELECT CASE WHEN updated_at <= TIMESTAMP '1998-07-01 00:00:00' THEN 'run1' ELSE 'run2' END AS run_id, * FROM source_orders
WHERE total_amount >= 0""", "source_orders"))
def _(spark, sf):
    target, _control, _results = two_incremental_runs(spark, sf)
    return target.valid()


@query("A8_incremental_watermarks", expect("""
SELECT 'p002' AS pipeline_id, 'run1' AS run_id, 1::BIGINT AS seq, max(updated_at) AS last_watermark FROM source_orders
WHERE total_amount >= 0 AND updated_at <= TIMESTAMP '1998-07-01 00:00:00'
UNION ALL SELECT 'p002', 'run2', 2, max(updated_at) FROM source_orders WHERE total_amount >= 0""", "source_orders"))
def _(spark, sf):
    _target, control, _results = two_incremental_runs(spark, sf)
    return control.log()


@query("A9_bounded_interval_runs", expect("""
SELECT 'run1' AS run_id, count(*) AS extracted, count(*) FILTER (total_amount >= 0) AS loaded,
       '1900-01-01 00:00:00' AS previous_watermark, '1998-07-01 00:00:00' AS new_watermark FROM source_orders
WHERE updated_at <= TIMESTAMP '1998-07-01 00:00:00'
UNION ALL SELECT 'run2', count(*), count(*) FILTER (total_amount >= 0), '1998-07-01 00:00:00', '2000-01-01 00:00:00' FROM source_orders
WHERE updated_at > TIMESTAMP '1998-07-01 00:00:00' AND updated_at <= TIMESTAMP '2000-01-01 00:00:00'""", "source_orders"))
def _(spark, sf):
    root = scratch_path(spark, "bounded")
    target, control = LandingTable(spark, f"{root}/orders"), WatermarkControl(spark, root)
    reason = F.when(F.col("total_amount") < 0, "NEGATIVE_AMOUNT")
    results = [
        incremental_load(lambda after, end: entities.source_orders(spark, sf, after, end), target, control, pipeline_id="p002",
                         run_id=run_id, watermark_column="updated_at", reason=reason, until=until)
        for run_id, until in (("run1", CUT), ("run2", "2000-01-01 00:00:00"))
    ]
    rows = [(r.run_id, r.extracted, r.loaded, r.previous_watermark, r.new_watermark) for r in results]
    return spark.createDataFrame(
        rows, "run_id string, extracted bigint, loaded bigint, previous_watermark string, new_watermark string"
    )


def flat_changes(spark, sf):
    """Flat change events on customers: signups insert, errors delete, the rest updates.

    Clicks do not supply an address, which leaves the stored one.
    """
    kind = F.col("event_type")
    return entities.events(spark, sf).select(
        F.col("user_id").alias("customer_id"), "event_id", "ts",
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("op"),
        F.lit("User").alias("first_name"), F.col("user_id").cast("string").alias("last_name"),
        F.when(kind != "click", F.concat_ws("", F.lit("u"), "user_id", F.lit("_"), "event_id", F.lit("@example.com"))).alias("email"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
    )


@query("A10_cdc_flat_events", expect("""
, chg AS (SELECT user_id AS customer_id, row_number() OVER (ORDER BY ts, event_id) AS s, ts,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
    CASE WHEN event_type <> 'click' THEN 'u' || user_id || '_' || event_id || '@example.com' END AS email FROM events),
lives AS (SELECT customer_id, 0 AS s, 'I' AS op, first_name, last_name, email, created_at, updated_at FROM customers
  UNION ALL SELECT customer_id, s, op, 'User', CAST(customer_id AS VARCHAR), email, ts, ts FROM chg WHERE op <> 'U'),
life AS (SELECT * FROM lives QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY s DESC) = 1)
SELECT l.customer_id, l.first_name, l.last_name,
       coalesce(arg_max(c.email, c.s) FILTER (c.email IS NOT NULL), l.email) AS email, l.created_at,
       coalesce(arg_max(c.ts, c.s) FILTER (c.ts IS NOT NULL), l.updated_at) AS updated_at
FROM life l LEFT JOIN chg c ON c.customer_id = l.customer_id AND c.op = 'U' AND c.s > l.s
WHERE l.op = 'I' GROUP BY l.customer_id, l.first_name, l.last_name, l.email, l.created_at, l.updated_at""", "customers"))
def cdc_flat(spark, sf):
    target = entities.customers(spark, sf).select("customer_id", "first_name", "last_name", "email", "created_at", "updated_at")
    return cdc.apply_flat_changes(target, flat_changes(spark, sf), "customer_id", ["email", "updated_at"], ["ts", "event_id"])


SEQ = ["line_number", "partner_id", "product_id", "quantity", "unit_price", "discount", "tax", "line_status"]


def envelopes(spark, sf):
    """Change envelopes on orders: each line is a change of its order, returned lines delete it."""
    flag = F.col("return_flag")
    image = F.struct(
        "order_id", F.when(F.col("line_status") == "F", "DELIVERED").otherwise("PENDING").alias("order_status"),
        F.col("unit_price").cast("double").alias("total_amount"),
    )
    return entities.order_items(spark, sf).select(
        F.when(flag == "R", "d").when(flag == "N", "c").otherwise("u").alias("op"),
        F.unix_millis(F.col("ship_ts").cast("timestamp")).alias("ts_ms"),
        F.when(flag != "N", image).alias("before"), F.when(flag != "R", image).alias("after"), *SEQ,
    )


_ENVELOPED = """
, newest AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ship_ts DESC, line_number DESC, partner_id DESC,
    product_id DESC, quantity DESC, unit_price DESC, discount DESC, tax DESC, line_status DESC) = 1)
SELECT h.order_id, h.order_status, h.total_amount FROM headers h WHERE h.order_id NOT IN (SELECT order_id FROM newest)
UNION ALL SELECT order_id, CASE line_status WHEN 'F' THEN 'DELIVERED' ELSE 'PENDING' END, CAST(unit_price AS DOUBLE) FROM newest WHERE return_flag <> 'R'"""


@query("A11_cdc_envelopes", expect(_ENVELOPED, "headers", "items"))
def _(spark, sf):
    target = entities.order_headers(spark, sf).select("order_id", "order_status", "total_amount")
    return cdc.apply_envelopes(target, envelopes(spark, sf), "order_id", SEQ)


@query("A12_replace_rows", """
SELECT user_id AS delivery_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS status, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""")
def _(spark, sf):
    messages = entities.events(spark, sf).select(
        F.col("user_id").alias("delivery_id"), "event_id", F.col("event_type").alias("status"), "value", "ts"
    )
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    stored = merge.latest_per_key(messages.where(F.col("ts") < middle), ["delivery_id"], ["event_id"])
    return merge.replace_rows(stored, messages.where(F.col("ts") >= middle), ["delivery_id"], ["event_id"]).drop("ts")


@query("A13_upsert_customers", expect("""
, t AS (SELECT * FROM customers WHERE created_at < TIMESTAMP '2024-10-01 00:00:00'),
b AS (SELECT * FROM customers WHERE updated_at >= TIMESTAMP '2024-07-01 00:00:00')
SELECT customer_id, CASE WHEN b.customer_id IS NOT NULL THEN last_name || ' the second' ELSE last_name END AS full_name,
  CASE WHEN b.customer_id IS NOT NULL THEN NULL ELSE email END AS masked_email,
  CASE WHEN t.customer_id IS NOT NULL THEN t.city ELSE 'FIRST' END AS city,
  CASE WHEN b.customer_id IS NOT NULL THEN c.updated_at + INTERVAL 1 DAY ELSE c.updated_at END AS updated_at
FROM customers c LEFT JOIN (SELECT customer_id, city FROM t) t USING (customer_id) LEFT JOIN (SELECT customer_id FROM b) b USING (customer_id)
WHERE t.customer_id IS NOT NULL OR b.customer_id IS NOT NULL""", "customers"))
def _(spark, sf):
    source = entities.customers(spark, sf).select(
        "customer_id", F.col("last_name").alias("full_name"), F.col("email").alias("masked_email"), "city", "created_at", "updated_at"
    )
    target = source.where(F.col("created_at") < F.lit("2024-10-01 00:00:00").cast("timestamp_ntz")).drop("created_at")
    late = source.where(F.col("updated_at") >= F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")).drop("created_at")
    # Every changed customer comes twice in the batch; the second row wins, with a NULL address.
    first = late.withColumn("city", F.lit("FIRST"))
    second = late.withColumns({
        "city": F.lit("SECOND"), "full_name": F.concat("full_name", F.lit(" the second")),
        "masked_email": F.lit(None).cast("string"),
        "updated_at": F.timestamp_add("DAY", F.lit(1), F.col("updated_at")),
    })
    update = ["full_name", "masked_email", "updated_at"]
    return merge.upsert(target, second.unionByName(first), ["customer_id"], update, ["updated_at"])


@query("A13_upsert_orders", expect("""
SELECT order_id, customer_id, CASE WHEN updated_at >= TIMESTAMP '1999-01-01 00:00:00' THEN 'DELIVERED' ELSE order_status END AS order_status,
       CASE WHEN updated_at >= TIMESTAMP '1999-01-01 00:00:00' THEN total_amount + 1 ELSE total_amount END AS total_amount, updated_at
FROM headers""", "headers"))
def _(spark, sf):
    columns = ["order_id", "customer_id", "order_status", "total_amount", "updated_at"]
    orders = entities.order_headers(spark, sf).select("created_at", *columns)
    target = orders.where(F.col("created_at") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).select(*columns)
    batch = orders.where(F.col("updated_at") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).withColumns({
        "order_status": F.lit("DELIVERED"), "total_amount": F.col("total_amount") + 1
    }).select(*columns)
    return merge.upsert(target, batch, ["order_id"], ["order_status", "total_amount", "updated_at"], ["updated_at"])


@query("A13_upsert_touched_partitions", expect("""
SELECT order_id, CASE WHEN created_at >= TIMESTAMP '2000-06-01 00:00:00' THEN 'DELIVERED' ELSE order_status END AS order_status,
       CASE WHEN created_at >= TIMESTAMP '2000-06-01 00:00:00' THEN updated_at + INTERVAL 1 DAY ELSE updated_at END AS updated_at,
       CAST(strftime(created_at, '%Y%m') AS INTEGER) AS order_month
FROM headers""", "headers"))
def _(spark, sf):
    orders = entities.order_headers(spark, sf)
    month = (F.year("created_at") * 100 + F.month("created_at")).alias("order_month")
    table = PartitionedTable(spark, scratch_path(spark, "by-month"), "order_month")
    known = orders.where(F.col("created_at") < F.lit("2000-09-01 00:00:00").cast("timestamp_ntz"))
    table.replace(known.select("order_id", "order_status", "updated_at", month), "known")
    # All orders since June are delivered a day later; those since September are new.
    late = orders.where(F.col("created_at") >= F.lit("2000-06-01 00:00:00").cast("timestamp_ntz"))
    batch = late.select(
        "order_id", F.lit("DELIVERED").alias("order_status"), F.timestamp_add("DAY", F.lit(1), F.col("updated_at")).alias("updated_at"), month
    )
    return layout.upsert_partitions(
        table, batch, ["order_id"], ["order_status", "updated_at"], ["updated_at"], "late", keys_move=False)


@query("A14_upsert_aggregate", expect("""
, fresh AS (SELECT order_date AS summary_date, store_id, count(order_id) AS total_orders, count(order_id) AS successful_orders,
  CAST(sum(CAST(total_amount AS DECIMAL(14,2))) AS DOUBLE) AS total_revenue FROM silver_orders
  WHERE order_status = 'DELIVERED' AND order_date >= DATE '2000-01-01' GROUP BY 1, 2)
SELECT * FROM fresh UNION ALL SELECT d.summary_date, d.store_id, d.total_orders, d.successful_orders, d.total_revenue FROM daily d
WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.summary_date = d.summary_date AND f.store_id = d.store_id)""", "daily"))
def _(spark, sf):
    columns = ["summary_date", "store_id", "total_orders", "successful_orders", "total_revenue"]
    silver = warehouse.silver_orders(spark, sf)
    recent = (F.col("order_status") == "DELIVERED") & (F.col("order_date") >= F.lit("2000-01-01").cast("date"))
    stored, fresh = gold.daily_sales(silver).select(*columns), gold.daily_sales(silver.where(recent)).select(*columns)
    # Stored by year: only the years of recomputed days are read and replaced.
    year = F.year("summary_date").alias("year")
    table = PartitionedTable(spark, scratch_path(spark, "daily"), "year")
    version = table.replace(stored.select("*", year), "first")
    fresh = materialise(fresh.select("*", year), "fresh")
    years = [r["year"] for r in fresh.select("year").distinct().collect()]
    merged = merge.replace_groups(table.read(only=years), fresh, ["summary_date", "store_id"])
    table.replace(merged, "fresh", touched=years, based_on=version)
    return table.read().select(*columns)


@query("A15_full_swap", expect("""
SELECT 1::BIGINT AS version, count(*) AS row_count, CAST(sum(CAST(balance AS DECIMAL(14,2))) AS DOUBLE) AS balance FROM customers
UNION ALL SELECT 2, count(*), CAST(sum(CAST(balance AS DECIMAL(14,2))) AS DOUBLE) FROM customers WHERE balance >= 0""", "customers"))
def _(spark, sf):
    swapped = VersionedTable(spark, scratch_path(spark, "swap"))
    customers = entities.customers(spark, sf)
    swapped.publish(customers, "run1")
    pinned = swapped.read()
    swapped.publish(customers.where(F.col("balance") >= 0), "run2")
    swapped.publish(customers, "run2")  # repeating a committed run changes nothing
    reads = {1: pinned, 2: swapped.read()}
    totals = [
        df.agg(F.count("*").alias("row_count"), sum_money("balance").alias("balance"))
        .select(F.lit(v).cast("bigint").alias("version"), "*")
        for v, df in reads.items()
    ]
    return totals[0].unionByName(totals[1])


@query("A16_insert_if_absent", expect("""
SELECT product_id, product_name, CASE WHEN category IN ('SMALL', 'PROMO') THEN price ELSE price + 1 END AS price FROM products""", "products"))
def _(spark, sf):
    products = entities.products(spark, sf).select("product_id", "product_name", "category", "price")
    stored = products.where(F.col("category").isin("SMALL", "PROMO"))
    return merge.insert_absent(stored, products.withColumn("price", F.col("price") + 1), ["product_id"]).drop("category")


def canonical_employees(spark, sf):
    """One employee model for two vendors; personal data stays behind."""
    crm = entities.employees_crm(spark, sf).select("employee_id", "full_name", "department", F.lit("crm").alias("source_system"))
    hr = entities.employees_hr(spark, sf).select(
        F.col("worker.id").alias("employee_id"), F.col("worker.legal_name").alias("full_name"), F.lit("hr").alias("source_system")
    )
    return crm.unionByName(hr, allowMissingColumns=True).withColumn("is_active", F.lit(1))


@query("A17_canonical_employees", """
SELECT 'EMP' || s_suppkey AS employee_id, s_name AS full_name, 'DEPT_' || s_nationkey AS department, 'crm' AS source_system, 1 AS is_active FROM supplier
UNION ALL SELECT 'W' || c_custkey, c_name, NULL, 'hr', 1 FROM customer""")
def _(spark, sf):
    return canonical_employees(spark, sf)


def six_sources(spark, sf):
    """A reader per control row; file-based sources are landed in their raw format first."""
    deliveries = landing.deliveries(spark, sf)
    return {
        "p001": lambda: entities.customers(spark, sf),
        "p002": lambda: entities.source_orders(spark, sf),
        "p003": lambda: landing.landed_csv(spark, entities.products(spark, sf)),
        "p004": lambda: readers.page_records(landing.landed_pages(spark, sf)).drop("page"),
        "p005": lambda: sinks.ndjson_stream(
            spark, landing.landed_ndjson(spark, deliveries), deliveries.schema
        ).withColumn("ts", F.to_timestamp_ntz("timestamp")),
        "p006": lambda: landing.landed_documents(
            spark, entities.employees_crm(spark, sf).withColumn("n", F.substring("employee_id", 4, 20).cast("bigint")), "n"
        ).drop("n"),
    }


def reject_reasons():
    """What the loads reject; the addresses are masked before they are judged."""
    return {
        "p001": routing.first_reason({"INVALID_EMAIL": F.col("email") == "***@masked.com"}),
        "p002": routing.first_reason({"NEGATIVE_AMOUNT": routing.negative("total_amount")}),
    }


@query("A18_metadata_ingestion", expect("""
SELECT 'run1' AS run_id, 'SUCCESS' AS status, 'p001' AS pipeline_id, count(*) AS records_extracted, count(*) FILTER (email LIKE '%@%') AS records_loaded,
       count(*) FILTER (email NOT LIKE '%@%') AS records_rejected FROM customers
UNION ALL SELECT 'run1', 'SUCCESS', 'p002', count(*), count(*) FILTER (total_amount >= 0), count(*) FILTER (total_amount < 0) FROM source_orders
UNION ALL SELECT 'run1', 'SUCCESS', 'p003', count(*), count(*), 0 FROM part
UNION ALL SELECT 'run1', 'SUCCESS', 'p004', count(*), count(*), 0 FROM orders
UNION ALL SELECT 'run1', 'SUCCESS', 'p005', count(*), count(*), 0 FROM events
UNION ALL SELECT 'run1', 'SUCCESS', 'p006', count(*), count(*), 0 FROM supplier""", "customers", "source_orders"))
def _(spark, sf):
    specs = ingest.specs_from_rows(read_config(warehouse.CONFIG / "sources.json")["sources"])
    results = ingest.ingest(
        spark, specs, six_sources(spark, sf), scratch_path(spark, "bronze"), "run1", reject_reasons(), pepper=PEPPER)
    return audit.audit_rows(spark, results)


@query("A19_six_source_counts", """
SELECT 'oltp_orders' AS source, count(*) AS row_count FROM orders UNION ALL SELECT 'csv_customers', count(*) FROM customer
UNION ALL SELECT 'json_app_events', count(*) FROM events UNION ALL SELECT 'api_payments', count(*) FROM orders
UNION ALL SELECT 'stream_deliveries', count(*) FROM events UNION ALL SELECT 'saas_employees', count(*) FROM supplier""")
def _(spark, sf):
    events, deliveries = landing.app_events(spark, sf), landing.deliveries(spark, sf)
    employees = entities.employees_crm(spark, sf).withColumn("n", F.substring("employee_id", 4, 20).cast("bigint"))
    sources = {
        "oltp_orders": entities.order_headers(spark, sf),
        "csv_customers": landing.landed_csv(spark, entities.customers(spark, sf)),
        "json_app_events": landing.landed_documents(spark, events, "event_id"),
        "api_payments": readers.page_records(landing.landed_pages(spark, sf)),
        "stream_deliveries": readers.ndjson_table(spark, landing.landed_ndjson(spark, deliveries), deliveries.schema),
        "saas_employees": landing.landed_documents(spark, employees, "n"),
    }
    return gold.layer_counts(sources).withColumnRenamed("layer", "source")


@query("A20_technical_columns", expect("""
SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS raw_id, TIMESTAMP '2024-06-01 00:00:00' AS ingested_at,
       'p001' AS pipeline_id, 1 AS has_input_file FROM customers""", "customers"))
def _(spark, sf):
    landed = landing.landed_csv(spark, entities.customers(spark, sf))
    bronze = readers.with_technical_columns(landed, RUN_TS, "p001").select("customer_id", "ingested_at", "input_file", "pipeline_id")
    # Landed text is parsed once; the numbering reads the parquet copy.
    numbered = ordered.ordered_window(materialise(bronze, "bronze"), {"raw_id": ordered.row_number()}, order_by=[("customer_id", "asc")], tiebreak=[])
    from_csv = F.when(F.col("input_file").endswith(".csv"), 1).otherwise(0)
    return numbered.withColumn("has_input_file", from_csv).drop("input_file")


@query("A21_mask_before_landing", expect("""
SELECT 'masked' AS style, customer_id, CASE WHEN email LIKE '%@%' THEN substr(email, 1, 2) || '***@example.com' ELSE '***@masked.com' END AS email,
       '+91XXXXXX' || right(phone, 4) AS phone, '***, ' || city AS delivery_address, sha256(phone || '_check-pepper') AS ssn FROM customers
UNION ALL SELECT 'raw', customer_id, email, phone, 'Street ' || customer_id || ', ' || city, phone FROM customers""", "customers"))
def _(spark, sf):
    address = F.concat(F.lit("Street "), F.col("customer_id").cast("string"), F.lit(", "), F.col("city"))
    raw = entities.customers(spark, sf).select(
        "customer_id", "email", "phone", address.alias("delivery_address"), F.col("phone").alias("ssn"))
    masked = vault.mask_configured(raw, ["email", "phone", "delivery_address", "ssn"], PEPPER)
    root = scratch_path(spark, "styles")
    for style, frame in (("masked", masked), ("raw", raw)):
        frame.write.parquet(f"{root}/style={style}")
    return spark.read.parquet(root)
