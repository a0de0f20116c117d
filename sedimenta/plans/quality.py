"""J: quality, contracts, audit and service levels."""

from __future__ import annotations

import datetime
import itertools
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import privacy
from sedimenta.operators import audit, gold, ingest, quality, regression, runs
from sedimenta.operators.incremental import incremental_load
from sedimenta.operators.quality import Contract, Rule
from sedimenta.plans import ingest as loads
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise, scratch_path
from sedimenta.sources import entities
from sedimenta.sources.config import read_config
from sedimenta.sources.readers import table as given_table
from sedimenta.sources.tables import LandingTable, VersionedTable, WatermarkControl

AS_OF = "2024-02-01 00:00:00"

CONTRACTS = read_config(warehouse.CONFIG / "contracts.json")["contracts"]


@query("J1_primary_key_duplicates", expect("""
SELECT 'order_item_line_duplicates' AS check_name, count(*) - count(DISTINCT k) AS violation_count
FROM (SELECT CAST(order_id AS VARCHAR) || '_' || CAST(line_number AS VARCHAR) AS k FROM items)
UNION ALL SELECT 'dim_customer_pk_duplicates', count(*) - count(DISTINCT customer_sk) FROM dim_customer""", "items", "dim_customer"))
def _(spark, sf):
    lines = entities.order_items(spark, sf).select(
        F.concat_ws("_", F.col("order_id").cast("string"), F.col("line_number").cast("string")).alias("k")
    )
    checks = {
        "order_item_line_duplicates": quality.surplus_keys(lines, "k"),
        "dim_customer_pk_duplicates": quality.surplus_keys(warehouse.dim_customer(spark, sf), "customer_sk"),
    }
    first, second = [d.select(F.lit(n).alias("check_name"), "violation_count") for n, d in checks.items()]
    return first.unionByName(second)


@query("J2_mandatory_not_null", expect("""
SELECT 'fact_null_customer' AS check_name, 'not_null' AS check_type, count(*) FILTER (customer_sk IS NULL) AS failed_count,
       'PASSED' AS status FROM facts
UNION ALL SELECT 'fact_null_date', 'not_null', count(*) FILTER (date_key IS NULL), 'PASSED' FROM facts
UNION ALL SELECT 'fact_null_product', 'not_null', count(*) FILTER (product_sk IS NULL), 'PASSED' FROM facts
UNION ALL SELECT 'fact_null_store', 'not_null', count(*) FILTER (store_sk IS NULL), 'PASSED' FROM facts
UNION ALL SELECT 'fact_order_item_null_fk', 'all_present',
  count(*) FILTER (customer_sk IS NULL OR product_sk IS NULL OR store_sk IS NULL OR date_key IS NULL), 'PASSED' FROM facts
UNION ALL SELECT 'fact_known_customer', 'min', count(*) FILTER (customer_sk < 0), 'FAILED' FROM facts""", "facts"))
def _(spark, sf):
    return quality.evaluate(warehouse.facts(spark, sf), [
        Rule("fact_null_product", "not_null", "product_sk"),
        Rule("fact_null_store", "not_null", "store_sk"),
        Rule("fact_order_item_null_fk", "all_present", None, ("customer_sk", "product_sk", "store_sk", "date_key")),
        Rule("fact_null_customer", "not_null", "customer_sk"),
        Rule("fact_null_date", "not_null", "date_key"),
        Rule("fact_known_customer", "min", "customer_sk", (0,)),
    ])


@query("J3_range_anomalies", expect("""
SELECT 'line_quantity_positive' AS check_name, 'gt' AS check_type, count(*) FILTER (quantity <= 0) AS failed_count, 'PASSED' AS status FROM items
UNION ALL SELECT 'line_price_non_negative', 'min', count(*) FILTER (unit_price < 0), 'PASSED' FROM items
UNION ALL SELECT 'line_total_non_negative', 'min', count(*) FILTER (total_price < 0), 'PASSED' FROM items
UNION ALL SELECT 'fact_negative_quantity_price', 'none_where', count(*) FILTER (quantity <= 0 OR unit_price < 0 OR total_price < 0), 'PASSED' FROM items
UNION ALL SELECT 'line_quantity_usual', 'between', count(*) FILTER (quantity NOT BETWEEN 1 AND 45), 'FAILED' FROM items""", "items"))
def _(spark, sf):
    return quality.evaluate(entities.order_items(spark, sf), [
        Rule("line_total_non_negative", "min", "total_price", (0,)),
        Rule("fact_negative_quantity_price", "none_where", None, ("quantity <= 0 OR unit_price < 0 OR total_price < 0",)),
        Rule("line_quantity_positive", "gt", "quantity", (0,)),
        Rule("line_price_non_negative", "min", "unit_price", (0,)),
        Rule("line_quantity_usual", "between", "quantity", (1, 45)),
    ])


@query("J4_referential_integrity", expect("""
SELECT 'orphan_order_customer' AS check_name, count(*) AS orphan_count FROM source_orders o
  WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = o.customer_id)
UNION ALL SELECT 'orphan_fact_customer_sk', count(*) FROM facts f WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_sk = f.customer_sk)
UNION ALL SELECT 'orphan_fact_product_sk', count(*) FROM facts f WHERE NOT EXISTS (SELECT 1 FROM dim_product p WHERE p.product_sk = f.product_sk)
UNION ALL SELECT 'orphan_fact_date_key', count(*) FROM facts f WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)""",
    "facts", "dim_date"))
def _(spark, sf):
    # The fact table is built once; each check scans one of its columns.
    facts = materialise(warehouse.facts(spark, sf, "customers", "products").select("customer_sk", "product_sk", "date_key"), "fact-keys")
    checks = [
        quality.orphan_count(facts, "customer_sk", warehouse.dim_customer(spark, sf), "orphan_fact_customer_sk"),
        quality.orphan_count(entities.source_orders(spark, sf), "customer_id", warehouse.dim_customer(spark, sf), "orphan_order_customer"),
        quality.orphan_count(facts, "product_sk", warehouse.dim_product(spark, sf), "orphan_fact_product_sk"),
        quality.orphan_count(facts, "date_key", warehouse.dim_date(spark, sf), "orphan_fact_date_key"),
    ]
    return reduce(DataFrame.unionByName, checks)


@query("J5_status_sla", expect("""
SELECT pipeline_id, max(end_time) AS last_processed_ts, arg_max(status, (end_time, run_id)) AS last_run_status,
       arg_max(records_loaded, (end_time, run_id)) AS records_loaded, arg_max(records_rejected, (end_time, run_id)) AS records_rejected,
       CASE WHEN arg_max(status, (end_time, run_id)) = 'SUCCESS' THEN 'SLA_MET' ELSE 'SLA_BREACH' END AS sla_compliance
FROM audit GROUP BY pipeline_id""", "audit"))
def _(spark, sf):
    return audit.status_sla(warehouse.audit(spark, sf))


@query("J5_freshness_sla", expect("""
SELECT pipeline_id, max(end_time) FILTER (status = 'SUCCESS') AS last_success_ts,
       date_sub('minute', max(end_time) FILTER (status = 'SUCCESS'), TIMESTAMP '2024-02-01 00:00:00') AS minutes_since_success,
       CASE WHEN date_sub('minute', max(end_time) FILTER (status = 'SUCCESS'), TIMESTAMP '2024-02-01 00:00:00') < 2880
            THEN 'SLA_MET' ELSE 'SLA_BREACH' END AS freshness FROM audit GROUP BY pipeline_id""", "audit"))
def _(spark, sf):
    return audit.freshness_sla(warehouse.audit(spark, sf), AS_OF, threshold_minutes=2880)


@query("J6_duplicate_key_listing", expect("""
SELECT customer_id, count(*) AS row_count FROM headers GROUP BY customer_id HAVING count(*) > 1""", "headers"))
def _(spark, sf):
    return quality.duplicate_keys(entities.order_headers(spark, sf), ["customer_id"])


@query("J7_null_or_empty_count", expect("""
SELECT 'masked_email_present' AS check_name, 'not_empty' AS check_type, count(*) FILTER (balance < 0) AS failed_count,
       CASE WHEN count(*) FILTER (balance < 0) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM customers""", "customers"))
def _(spark, sf):
    masked = F.when(F.col("balance") < 0, "").otherwise(privacy.mask_email_short("email"))
    customers = entities.customers(spark, sf).withColumn("masked_email", masked)
    return quality.evaluate(customers, [Rule("masked_email_present", "not_empty", "masked_email")])


@query("J8_customer_contract", expect("""
SELECT * FROM (VALUES ('has_customer_id', 'schema', 0::BIGINT), ('has_first_name', 'schema', 0), ('has_last_name', 'schema', 0),
  ('has_email', 'schema', 0), ('has_created_at', 'schema', 0), ('customer_id_is_int', 'schema', 0), ('first_name_is_string', 'schema', 0),
  ('last_name_is_string', 'schema', 0), ('email_is_email', 'schema', 0)) t(check_name, check_type, failed_count), (SELECT 'PASSED' AS status)
UNION ALL SELECT 'customer_id_not_null', 'not_null', count(*) FILTER (customer_id IS NULL), 'PASSED' FROM customers
UNION ALL SELECT 'email_format', 'regex', count(*) FILTER (NOT regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$')), 'FAILED' FROM customers
UNION ALL SELECT 'email_contains_at', 'contains', count(*) FILTER (NOT contains(email, '@')), 'FAILED' FROM customers""", "customers"))
def _(spark, sf):
    return quality.check_contract(entities.customers(spark, sf), Contract.from_spec("customers", CONTRACTS["customers"]))


@query("J8_contract_row_reasons", expect("""
SELECT order_id, CASE WHEN total_amount < 0 AND total_amount < -300000 THEN 'amount_non_negative,refund_limit'
  ELSE 'amount_non_negative' END AS failed_rules FROM source_orders WHERE total_amount < 0""", "source_orders"))
def _(spark, sf):
    contract = Contract.from_spec("orders", CONTRACTS["orders"])
    rules = [*contract.rules, Rule("refund_limit", "min", "total_amount", (-300000,))]
    return entities.source_orders(spark, sf).select(
        "order_id", F.concat_ws(",", quality.failed_rules(rules)).alias("failed_rules")
    ).where(F.col("failed_rules") != "")


@query("J9_expectations", expect("""
SELECT 'customer_id_not_null' AS check_name, 'not_null' AS check_type, 0::BIGINT AS failed_count, 'PASSED' AS status
UNION ALL SELECT 'net_amount_between', 'between', count(*) FILTER (net_amount NOT BETWEEN 0 AND 1000000),
  CASE WHEN count(*) FILTER (net_amount NOT BETWEEN 0 AND 1000000) = 0 THEN 'PASSED' ELSE 'FAILED' END FROM facts
UNION ALL SELECT 'row_count_between', 'row_count_between', 0, 'PASSED'
UNION ALL SELECT 'order_id_unique', 'unique', count(*) - count(DISTINCT order_id), 'FAILED' FROM facts""", "facts"))
def _(spark, sf):
    # Uniqueness takes a pass of its own, so the join is made once and its three columns are kept.
    facts = materialise(warehouse.facts(spark, sf, "customers").select("order_id", "customer_sk", "net_amount"), "expected-facts")
    return quality.evaluate(facts, [
        Rule("customer_id_not_null", "not_null", "customer_sk"),
        Rule("net_amount_between", "between", "net_amount", (0, 1_000_000)),
        Rule("row_count_between", "row_count_between", None, (1, None)),
        Rule("order_id_unique", "unique", "order_id"),
    ])


@query("J9_quality_log", expect("""
SELECT 'r1' AS run_id, 'p001' AS pipeline_id, 'email_has_at' AS check_name, 'contains' AS check_type, 'FAILED' AS status,
       count(*) FILTER (email NOT LIKE '%@%') AS failed_count, TIMESTAMP '2024-02-01 00:00:00' AS check_timestamp FROM customers
UNION ALL SELECT 'r1', 'p001', 'customer_unique', 'unique', 'PASSED', count(*) - count(DISTINCT customer_id), TIMESTAMP '2024-02-01 00:00:00' FROM customers
UNION ALL SELECT 'r1', 'p001', 'phone_length', 'length', 'PASSED', count(*) FILTER (length(phone) NOT BETWEEN 13 AND 13), TIMESTAMP '2024-02-01 00:00:00' FROM customers""", "customers"))
def _(spark, sf):
    outcome = quality.evaluate(entities.customers(spark, sf), [
        Rule("email_has_at", "contains", "email", ("@",)),
        Rule("customer_unique", "unique", "customer_id"),
        Rule("phone_length", "length", "phone", (13, 13)),
    ])
    return quality.as_results(outcome, "r1", "p001", AS_OF)


@query("J10_publish_gate", expect("""
SELECT 'customers' AS subject, 12::BIGINT AS checks, 2::BIGINT AS failed_checks, 0::BIGINT AS failed_schema_checks, 'HALT_PUBLISH' AS verdict
FROM customers WHERE email NOT LIKE '%@%' HAVING count(*) > 0
UNION ALL SELECT 'silver_orders', 10, 0, 0, 'PUBLISH' FROM silver_orders WHERE total_amount < 0 HAVING count(*) = 0
UNION ALL SELECT 'bronze_orders', 10, CASE WHEN count(*) FILTER (total_amount < 0) > 0 THEN 2 ELSE 1 END, 1, 'HALT_RUN' FROM source_orders""",
    "customers", "silver_orders"))
def _(spark, sf):
    orders = Contract.from_spec("orders", CONTRACTS["orders"])
    subjects = {
        "customers": (entities.customers(spark, sf), Contract.from_spec("customers", CONTRACTS["customers"])),
        "silver_orders": (warehouse.silver_orders(spark, sf), orders),
        "bronze_orders": (entities.source_orders(spark, sf), orders),  # lacks order_date
    }
    verdicts = [
        quality.gate(quality.check_contract(df, contract)).select(F.lit(name).alias("subject"), "*")
        for name, (df, contract) in subjects.items()
    ]
    return verdicts[0].unionByName(verdicts[1]).unionByName(verdicts[2])


def publish_daily_sales(silver, table: VersionedTable, run_id: str) -> None:
    """Silver to gold behind the gates: contract, expectations, PII columns, then one atomic swap."""
    quality.require_pass(quality.check_contract(silver, Contract.from_spec("orders", CONTRACTS["orders"])))
    daily = materialise(gold.daily_sales(silver), "daily-sales")
    quality.require_pass(quality.evaluate(daily, [
        Rule("store_present", "not_null", "store_id"),
        Rule("revenue_non_negative", "min", "total_revenue", (0,)),
        Rule("rows_present", "row_count_between", None, (1, None)),
    ]))
    exposed = quality.pii_columns(daily, privacy.DIRECT_PII)
    if exposed:
        raise quality.GateClosed(f"gold exposes {exposed}")
    table.publish(daily, run_id)


@query("J10_gated_publish", expect("""
SELECT *, CASE WHEN successful_orders > 0 THEN total_revenue / CAST(successful_orders AS DOUBLE) END AS avg_delivered_value
FROM daily""", "daily"))
def _(spark, sf):
    table = VersionedTable(spark, scratch_path(spark, "gold"))
    publish_daily_sales(warehouse.silver_orders(spark, sf), table, "run1")
    return table.read()


@query("J11_completeness", expect("""
SELECT run_id, pipeline_id, records_extracted, records_loaded, records_rejected,
       records_extracted - records_loaded - records_rejected AS unaccounted,
       CASE WHEN records_extracted = records_loaded + records_rejected THEN 'SLA_MET' ELSE 'SLA_BREACH' END AS completeness FROM audit""", "audit"))
def _(spark, sf):
    return audit.completeness(warehouse.audit(spark, sf))


@query("J12_duration_sla", expect("""
SELECT run_id, pipeline_id, records_loaded, date_sub('second', start_time, end_time) AS duration_seconds,
       CASE WHEN date_sub('second', start_time, end_time) > 0 THEN CAST(records_loaded AS DOUBLE) / CAST(date_sub('second', start_time, end_time) AS DOUBLE) END AS rows_per_second,
       CASE WHEN date_sub('second', start_time, end_time) <= 85000 THEN 'SLA_MET' ELSE 'SLA_BREACH' END AS duration FROM audit""", "audit"))
def _(spark, sf):
    return audit.duration_sla(warehouse.audit(spark, sf), limit_seconds=85_000)


@query("J13_run_audit", expect("""
SELECT 'run-1' AS run_id, 'p002' AS pipeline_id, 'SUCCESS' AS status, count(*) AS records_extracted,
       count(*) FILTER (total_amount >= 0) AS records_loaded, count(*) FILTER (total_amount < 0) AS records_rejected FROM source_orders
UNION ALL SELECT 'run-1', 'p001', 'SUCCESS', count(*), count(*) FILTER (email LIKE '%@%'), count(*) FILTER (email NOT LIKE '%@%') FROM customers""",
    "source_orders", "customers"))
def _(spark, sf):
    root = scratch_path(spark, "audited")
    control = WatermarkControl(spark, root)
    orders = incremental_load(
        entities.source_orders(spark, sf), LandingTable(spark, f"{root}/orders"), control, pipeline_id="p002",
        run_id="run-1", watermark_column="updated_at", reason=F.when(F.col("total_amount") < 0, "NEGATIVE_AMOUNT"),
    )
    customers = incremental_load(
        entities.customers(spark, sf), LandingTable(spark, f"{root}/customers"), control, pipeline_id="p001",
        run_id="run-1", watermark_column="updated_at", reason=F.when(~F.col("email").contains("@"), "INVALID_EMAIL"),
    )
    return audit.audit_rows(spark, [orders, customers])


def _clock(first: str, step_seconds: int):
    """A clock that goes on by ``step_seconds`` whenever it is read."""
    ticks = itertools.count()
    start = datetime.datetime.fromisoformat(first)
    return lambda: (start + datetime.timedelta(seconds=step_seconds * next(ticks))).strftime("%Y-%m-%d %H:%M:%S.%f")


def audited_runs(spark, sf):
    """Six sources of which one cannot be reached, after a run that died while it loaded the last one."""
    def unreachable():
        raise ConnectionError("page 2 timed out")

    root = scratch_path(spark, "audited")
    record = runs.RunAudit(spark, root, _clock("2024-06-01 00:00:00", 60))
    record.start("run0", "p006")
    specs = ingest.specs_from_rows(read_config(warehouse.CONFIG / "sources.json")["sources"])
    sources = loads.six_sources(spark, sf) | {"p004": unreachable}
    ingest.ingest(spark, specs, sources, root, "run1", loads.reject_reasons(), record, wait_seconds=0, pepper=loads.PEPPER)
    return record, root


_RUNS = """runs AS (
SELECT 'run0' AS run_id, 'p006' AS pipeline_id, 'FAILED' AS status, 0 AS start_minute, 1 AS end_minute, 0 AS records_extracted, 0 AS records_rejected,
       'ended without a result, closed by run1' AS error_message
UNION ALL SELECT 'run1', 'p001', 'SUCCESS', 2, 3, count(*), count(*) FILTER (email NOT LIKE '%@%'), NULL FROM customers
UNION ALL SELECT 'run1', 'p002', 'SUCCESS', 4, 5, count(*), count(*) FILTER (total_amount < 0), NULL FROM source_orders
UNION ALL SELECT 'run1', 'p003', 'SUCCESS', 6, 7, count(*), 0, NULL FROM part
UNION ALL SELECT 'run1', 'p004', 'FAILED', 8, 9, 0, 0, 'ConnectionError: page 2 timed out'
UNION ALL SELECT 'run1', 'p005', 'SUCCESS', 10, 11, count(*), 0, NULL FROM events
UNION ALL SELECT 'run1', 'p006', 'SUCCESS', 12, 13, count(*), 0, NULL FROM supplier),
run_audit AS (SELECT run_id, pipeline_id, status, TIMESTAMP '2024-06-01 00:00:00' + to_minutes(start_minute) AS start_time,
  TIMESTAMP '2024-06-01 00:00:00' + to_minutes(end_minute) AS end_time, CAST(records_extracted AS BIGINT) AS records_extracted,
  CAST(records_extracted - records_rejected AS BIGINT) AS records_loaded, CAST(records_rejected AS BIGINT) AS records_rejected, error_message FROM runs)"""


@query("J13_run_states", expect(", " + _RUNS + " SELECT * FROM run_audit", "customers", "source_orders"))
def _(spark, sf):
    return audited_runs(spark, sf)[0].frame()


@query("J13_whole_run_status", """
SELECT 'run0' AS run_id, 'FAILED' AS status, 1::BIGINT AS failed_loads UNION ALL SELECT 'run1', 'PARTIAL', 1""")
def _(spark, sf):
    return audited_runs(spark, sf)[0].run_status()


@query("J5_status_sla_of_runs", expect(", " + _RUNS + """
SELECT pipeline_id, end_time AS last_processed_ts, status AS last_run_status, records_loaded, records_rejected,
       CASE WHEN status = 'SUCCESS' THEN 'SLA_MET' ELSE 'SLA_BREACH' END AS sla_compliance FROM run_audit WHERE run_id = 'run1'""",
    "customers", "source_orders"))
def _(spark, sf):
    return audit.status_sla(audited_runs(spark, sf)[0].frame())


@query("J11_completeness_of_runs", expect(", " + _RUNS + """
SELECT run_id, pipeline_id, records_extracted, records_loaded, records_rejected, 0::BIGINT AS unaccounted, 'SLA_MET' AS completeness FROM run_audit""",
    "customers", "source_orders"))
def _(spark, sf):
    return audit.completeness(audited_runs(spark, sf)[0].frame())


@query("J12_duration_sla_of_runs", expect(", " + _RUNS + """
SELECT run_id, pipeline_id, records_loaded, 60::BIGINT AS duration_seconds, CAST(records_loaded AS DOUBLE) / 60 AS rows_per_second, 'SLA_MET' AS duration
FROM run_audit""", "customers", "source_orders"))
def _(spark, sf):
    return audit.duration_sla(audited_runs(spark, sf)[0].frame(), limit_seconds=60)


@query("B11_quarantine_in_loads", expect("""
SELECT 'run1' AS run_id, 'p002' AS pipeline_id, 'NEGATIVE_AMOUNT' AS reason_code, order_id AS payload_key FROM source_orders WHERE total_amount < 0
UNION ALL SELECT 'run1', 'p001', 'INVALID_EMAIL', customer_id FROM customers WHERE email NOT LIKE '%@%'""", "source_orders", "customers"))
def _(spark, sf):
    _record, root = audited_runs(spark, sf)
    key = F.coalesce(F.get_json_object("raw_payload", "$.order_id"), F.get_json_object("raw_payload", "$.customer_id"))
    return ingest.quarantined(spark, root).select("run_id", "pipeline_id", "reason_code", key.cast("bigint").alias("payload_key"))


@query("J14_golden_compare", expect("""
SELECT (SELECT count(*) FROM items) AS actual_rows, (SELECT count(*) FROM items) AS golden_rows,
       (SELECT count(*) FROM items WHERE quantity > 45) AS missing_rows, (SELECT count(*) FROM items WHERE quantity > 45) AS unexpected_rows,
       'FAILED' AS status""", "items"))
def _(spark, sf):
    golden = entities.order_items(spark, sf)
    # A capped quantity is the regression to be found in the actual table.
    actual = golden.withColumn("quantity", F.least("quantity", F.lit(45).cast("bigint")))
    return regression.compare_to_golden(actual, golden)


@query("J15_schema_drift", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'new_unannounced_field' ELSE '' END AS unexpected_fields,
       CASE WHEN event_type = 'signup' THEN 'k' ELSE '' END AS missing_fields,
       CASE WHEN event_type = 'error' THEN 'user_id' ELSE '' END AS mistyped_fields
FROM events WHERE event_type IN ('error', 'signup')""")
def _(spark, sf):
    # Error events drift: a text in place of the user number and a field nobody announced; signups lack a field.
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    regular = F.to_json(F.struct("event_id", "user_id", k.alias("k")))
    drifted = F.to_json(F.struct(
        "event_id", F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"), k.alias("k"),
        F.col("value").alias("new_unannounced_field"),
    ))
    reduced = F.to_json(F.struct("event_id", "user_id"))
    payloads = entities.events(spark, sf).select(
        "event_id", F.when(kind == "error", drifted).when(kind == "signup", reduced).otherwise(regular).alias("payload")
    )
    expected = {"event_id": "bigint", "user_id": "bigint", "k": "int"}
    return quality.schema_drift(payloads, "event_id", "payload", expected).drop("payload")


@query("J16_gold_pii_columns", expect("""
SELECT 'gold_daily_sales' AS table_name, '' AS pii_columns, 1 AS is_free, count(*) AS row_count FROM daily
UNION ALL SELECT 'dim_customer', 'email,first_name,last_name', 0, count(*) FROM dim_customer""", "daily", "dim_customer"))
def _(spark, sf):
    tables = {
        "gold_daily_sales": gold.daily_sales(warehouse.silver_orders(spark, sf)),
        "dim_customer": warehouse.dim_customer(spark, sf),
    }
    verdicts = []
    for name, df in tables.items():
        found = sorted(quality.pii_columns(df, privacy.DIRECT_PII))
        verdicts.append(df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(found)).alias("pii_columns"),
            F.lit(0 if found else 1).alias("is_free"), "row_count",
        ))
    return verdicts[0].unionByName(verdicts[1])


@query("J16_pii_value_scan", """
SELECT 'text' AS column_name, 'email' AS pattern, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\\.[A-Za-z0-9.-]+')) AS row_count FROM documents
UNION ALL SELECT 'text', 'phone', count(*) FILTER (regexp_matches(text, '\\+?[0-9][0-9() -]{8,}[0-9]')) FROM documents
UNION ALL SELECT 'source', 'email', 0 UNION ALL SELECT 'source', 'phone', 0""")
def _(spark, sf):
    documents = given_table(spark, sf, "documents").select("text", "source")
    return quality.pii_value_counts(documents, {
        "email": r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", "phone": r"\+?[0-9][0-9() -]{8,}[0-9]",
    })
