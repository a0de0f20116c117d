"""B: projection, cleaning and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import dates, text
from sedimenta.operators import merge, routing
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import scratch_path
from sedimenta.sources import entities
from sedimenta.sources.tables import LandingTable

RUN_TS = "2024-06-01 00:00:00"
PAYLOAD = ["order_id", "customer_id", "store_id", "total_amount", "created_at", "updated_at"]
PAYLOAD_SCHEMA = (
    "order_id bigint, customer_id bigint, store_id bigint, total_amount double, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)



@query("B1_standardise_text", expect("""
-- Cleaning undoes what the careless source has done to the entity.
SELECT customer_id, first_name, last_name, lower(email) AS email, city, upper(state) AS state FROM customers""", "customers"))
def _(spark, sf):
    return entities.bronze_customers(spark, sf).select(
        "customer_id", text.clean("first_name").alias("first_name"), text.clean("last_name").alias("last_name"),
        text.clean_lower("email").alias("email"), text.clean("city").alias("city"),
        text.clean_upper("state").alias("state"),
    )


@query("B2_validity_flag_and_note", expect("""
-- Every customer has an id. An address that is withheld is not valid, and no rule names it.
SELECT customer_id, CAST(balance >= 0 AND well_formed AS INTEGER) AS is_valid,
       if(balance >= 0 AND NOT well_formed, 'INVALID_EMAIL_FORMAT', 'CLEAN') AS validation_notes
FROM (SELECT customer_id, balance, regexp_matches(email, '@.*[.]') AS well_formed FROM customers)""", "customers"))
def _(spark, sf):
    # Addresses of customers in debt are withheld, which exercises the NULL case.
    source = entities.customers(spark, sf).withColumn("email", F.when(F.col("balance") >= 0, F.col("email")))
    return source.select(
        "customer_id", text.validity_flag("email", "customer_id").alias("is_valid"),
        text.validity_note("email", "customer_id").alias("validation_notes"),
    )


@query("B3_keep_usable_customers", expect("""
SELECT customer_id, email FROM (SELECT customer_id, CASE WHEN balance < 0 THEN '' ELSE email END AS email FROM customers)
WHERE customer_id <> 0 AND email <> ''""", "customers"))
def _(spark, sf):
    source = entities.customers(spark, sf).withColumn(
        "email", F.when(F.col("balance") < 0, "").otherwise(F.col("email"))
    )
    return routing.keep_usable_customers(source).select("customer_id", "email")


@query("B3_keep_usable_orders", expect("""
SELECT order_id, total_amount FROM source_orders WHERE order_id IS NOT NULL AND total_amount >= 0""", "source_orders"))
def _(spark, sf):
    return routing.keep_usable_orders(entities.source_orders(spark, sf)).select("order_id", "total_amount")


@query("B4_full_name", expect("SELECT customer_id, first_name || ' ' || last_name AS full_name FROM customers", "customers"))
def _(spark, sf):
    return entities.customers(spark, sf).select("customer_id", text.full_name("first_name", "last_name").alias("full_name"))


@query("B5_order_date", expect("""
SELECT order_id, CASE WHEN order_status = 'PENDING' THEN DATE '1900-01-01' ELSE CAST(created_at AS DATE) END AS order_date
FROM headers""", "headers"))
def _(spark, sf):
    source = entities.order_headers(spark, sf).withColumn(
        "created_at", F.when(F.col("order_status") != "PENDING", F.col("created_at"))
    )
    return source.select("order_id", dates.order_date("created_at").alias("order_date"))


@query("B6_route_invalid_email", expect("""
SELECT customer_id, email, CASE WHEN email LIKE '%@%' THEN 'valid' ELSE 'rejected' END AS route,
       CASE WHEN email LIKE '%@%' THEN NULL ELSE 'INVALID_EMAIL' END AS reason_code FROM customers""", "customers"))
def _(spark, sf):
    landing = LandingTable(spark, scratch_path(spark, "bronze-customers"))
    reason = routing.first_reason({text.INVALID_EMAIL: routing.invalid_email()})
    landing.write_run(entities.customers(spark, sf).select("customer_id", "email").withColumn("reason_code", reason), "r1")
    valid = landing.valid().withColumn("reason_code", F.lit(None).cast("string")).withColumn("route", F.lit("valid"))
    rejected = landing.rejected().withColumn("route", F.lit("rejected"))
    return valid.unionByName(rejected).select("customer_id", "email", "route", "reason_code")


@query("B7_route_negative_amount", expect("""
SELECT order_id, total_amount, CASE WHEN total_amount < 0 THEN 'NEGATIVE_AMOUNT' ELSE 'VALID' END AS outcome
FROM source_orders""", "source_orders"))
def _(spark, sf):
    reason = routing.first_reason({text.NEGATIVE_AMOUNT: routing.negative("total_amount")})
    return entities.source_orders(spark, sf).select(
        "order_id", "total_amount", F.coalesce(reason, F.lit("VALID")).alias("outcome")
    )


@query("B8_route_all_reasons", expect("""
SELECT customer_id, CASE WHEN reasons = '' THEN NULL ELSE 'DATA_QUALITY_FAILURE' END AS error_code, reasons AS error_reasons
FROM (SELECT customer_id,
        CASE WHEN balance < 0 THEN 'ERR_NEG_AMOUNT: Amount must be non-negative' ELSE '' END
        || CASE WHEN balance < 0 AND email NOT LIKE '%@%' THEN '; ' ELSE '' END
        || CASE WHEN email NOT LIKE '%@%' THEN 'ERR_INVALID_EMAIL: Email missing @ domain' ELSE '' END AS reasons
      FROM customers)""", "customers"))
def _(spark, sf):
    reasons = routing.all_reasons(routing.lab_rules("email", "balance"))
    return entities.customers(spark, sf).select("customer_id", reasons.alias("error_reasons")).withColumn(
        "error_code", F.when(F.col("error_reasons") != "", text.DATA_QUALITY_FAILURE)
    )


@query("B9_line_amounts", expect("""
SELECT order_id, product_id, partner_id, line_number, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount_amount AS DOUBLE) AS discount_amount FROM items""", "items"))
def _(spark, sf):
    amounts = [F.col(c).cast("double").alias(c) for c in ("unit_price", "total_price", "discount_amount")]
    return entities.order_items(spark, sf).select(
        "order_id", "product_id", "partner_id", "line_number", "quantity", *amounts
    )


def order_rejects(spark, sf):
    rejected = entities.source_orders(spark, sf).withColumn(
        "reason_code", routing.first_reason({text.NEGATIVE_AMOUNT: routing.negative("total_amount")})
    ).where(F.col("reason_code").isNotNull())
    return routing.quarantine(
        rejected, run_id="r1", pipeline_id="p002", run_ts=RUN_TS, details="Order total amount is negative", payload=PAYLOAD
    )


def customer_rejects(spark, sf):
    rules = {text.INVALID_EMAIL: routing.invalid_email(), text.NEGATIVE_AMOUNT: routing.negative("balance")}
    rejected = entities.customers(spark, sf).withColumn("reason_code", routing.first_reason(rules)).where(
        F.col("reason_code").isNotNull()
    )
    return routing.quarantine(
        rejected, run_id="r1", pipeline_id="p001", run_ts=RUN_TS, details="Customer check failed",
        payload=["customer_id", "email", "balance"],
    )


@query("B10_classify_errors", expect("""
SELECT order_id, outcome AS reason_code,
       CASE outcome WHEN 'NEGATIVE_AMOUNT' THEN 'DATA' WHEN 'TIMEOUT' THEN 'TRANSIENT' ELSE 'SCHEMA' END AS error_class,
       CASE outcome WHEN 'NEGATIVE_AMOUNT' THEN 'QUARANTINE' WHEN 'TIMEOUT' THEN 'RETRY' ELSE 'HALT' END AS action
FROM (SELECT order_id, CASE WHEN total_amount < 0 THEN 'NEGATIVE_AMOUNT' WHEN order_status = 'PENDING' THEN 'TIMEOUT'
             ELSE 'SCHEMA_DRIFT' END AS outcome FROM source_orders)""", "source_orders"))
def _(spark, sf):
    failures = entities.source_orders(spark, sf).select(
        "order_id",
        F.when(F.col("total_amount") < 0, "NEGATIVE_AMOUNT").when(F.col("order_status") == "PENDING", "TIMEOUT")
        .otherwise("SCHEMA_DRIFT").alias("reason_code"),
    )
    return routing.classify(failures)


@query("B11_quarantine_records", expect("""
SELECT 'r1' AS run_id, 'p002' AS pipeline_id, 'NEGATIVE_AMOUNT' AS reason_code,
       'Order total amount is negative' AS error_details, TIMESTAMP '2024-06-01 00:00:00' AS created_at,
       order_id AS payload_order_id, total_amount AS payload_amount
FROM source_orders WHERE total_amount < 0""", "source_orders"))
def _(spark, sf):
    payload = F.from_json("raw_payload", PAYLOAD_SCHEMA)
    return order_rejects(spark, sf).withColumn("_p", payload).select(
        "run_id", "pipeline_id", "reason_code", "error_details", "created_at",
        F.col("_p.order_id").alias("payload_order_id"), F.col("_p.total_amount").alias("payload_amount"),
    )


@query("B12_correct_and_replay", expect("""
SELECT order_id, customer_id, CASE WHEN total_amount < 0 THEN 'REPLAYED' ELSE order_status END AS order_status,
       abs(total_amount) AS total_amount, CAST(created_at AS DATE) AS order_date FROM source_orders""", "source_orders"))
def _(spark, sf):
    columns = ["order_id", "customer_id", "order_status", "total_amount", "order_date", "updated_at"]
    silver = warehouse.silver_orders(spark, sf).select(*columns)
    corrected = routing.corrected_negatives(order_rejects(spark, sf), PAYLOAD_SCHEMA, "total_amount")
    replay = corrected.withColumn("order_status", F.lit("REPLAYED")).withColumn(
        "order_date", dates.order_date("created_at")
    ).select(*columns)
    return merge.upsert(silver, replay, ["order_id"], ["total_amount"], ["updated_at"]).drop("updated_at")


@query("B12_replay_marks", expect("""
SELECT order_id AS payload_order_id, 'NEGATIVE_AMOUNT' AS reason_code, TIMESTAMP '2024-06-02 00:00:00' AS replayed_at
FROM source_orders WHERE total_amount < 0
UNION ALL SELECT customer_id, 'INVALID_EMAIL', NULL FROM customers WHERE email NOT LIKE '%@%'
UNION ALL SELECT customer_id, 'NEGATIVE_AMOUNT', NULL FROM customers WHERE email LIKE '%@%' AND balance < 0""",
    "source_orders", "customers"))
def _(spark, sf):
    # Rejected customers carry no order amount, so a replay of orders leaves them open.
    rejects = order_rejects(spark, sf).unionByName(customer_rejects(spark, sf))
    key = F.coalesce(F.get_json_object("raw_payload", "$.order_id"), F.get_json_object("raw_payload", "$.customer_id"))
    return routing.mark_replayed(rejects, PAYLOAD_SCHEMA, "total_amount", "2024-06-02 00:00:00").select(
        key.cast("bigint").alias("payload_order_id"), "reason_code", "replayed_at"
    )


@query("B11_distinct_rejects", expect("""
SELECT order_id AS payload_order_id, 'NEGATIVE_AMOUNT' AS reason_code, 'r1' AS run_id,
       CASE WHEN order_status = 'PENDING' THEN 2 ELSE 1 END::BIGINT AS seen FROM source_orders WHERE total_amount < 0""", "source_orders"))
def _(spark, sf):
    # A second run meets the rejects among the pending orders again.
    rejects = order_rejects(spark, sf)
    pending = entities.source_orders(spark, sf).where(
        (F.col("order_status") == "PENDING") & (F.col("total_amount") < 0)
    ).withColumn("reason_code", F.lit(text.NEGATIVE_AMOUNT))
    again = routing.quarantine(
        pending, run_id="r2", pipeline_id="p002", run_ts="2024-06-02 00:00:00", details="Order total amount is negative", payload=PAYLOAD
    )
    return routing.distinct_rejects(rejects.unionByName(again)).select(
        F.get_json_object("raw_payload", "$.order_id").cast("bigint").alias("payload_order_id"), "reason_code", "run_id", "seen"
    )


@query("B13_reject_report", expect("""
SELECT 'p002' AS pipeline_id, 'NEGATIVE_AMOUNT' AS reason_code, count(*) AS reject_count FROM source_orders
WHERE total_amount < 0
UNION ALL SELECT 'p001', CASE WHEN email NOT LIKE '%@%' THEN 'INVALID_EMAIL' ELSE 'NEGATIVE_AMOUNT' END, count(*)
FROM customers WHERE email NOT LIKE '%@%' OR balance < 0 GROUP BY ALL""", "source_orders", "customers"))
def _(spark, sf):
    return routing.reject_report(order_rejects(spark, sf).unionByName(customer_rejects(spark, sf)))
