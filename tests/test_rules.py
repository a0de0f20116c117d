"""Routing, contracts, masking and golden vectors of the seeded defects."""

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import privacy, text
from sedimenta.operators import quality, regression, routing, vault
from sedimenta.operators.quality import Contract, GateClosed, Rule
from sedimenta.plans.quality import CONTRACTS


def test_one_bad_address_in_a_hundred(spark):
    people = spark.range(1, 101).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") == 22, "bad_email_at_domain").otherwise(F.concat(F.lit("c"), "id", F.lit("@example.com"))).alias("email"),
    )
    routed = people.withColumn("reason_code", routing.first_reason({text.INVALID_EMAIL: routing.invalid_email()}))
    counts = {r["reason_code"]: r["count"] for r in routed.groupBy("reason_code").count().collect()}
    assert counts == {None: 99, "INVALID_EMAIL": 1}


def test_all_reasons_and_missing_values(spark, rows):
    df = spark.createDataFrame([(1, -5.0, "x"), (2, None, None), (3, 1.0, "a@b")], "id int, amount double, email string")
    out = df.select("id", routing.all_reasons(routing.lab_rules("email", "amount")).alias("r"))
    assert rows(out) == [
        (1, f"{routing.REASON_NEGATIVE}; {routing.REASON_EMAIL}"), (2, routing.REASON_EMAIL), (3, "")
    ]


def test_null_address_is_invalid_but_clean(spark):
    df = spark.createDataFrame([(1, None), (None, "a@b.c"), (2, "nope")], "customer_id int, email string")
    got = df.select(text.validity_flag("email", "customer_id"), text.validity_note("email", "customer_id")).collect()
    assert [tuple(r) for r in got] == [(0, "CLEAN"), (0, "MISSING_CUSTOMER_ID"), (0, "INVALID_EMAIL_FORMAT")]


def test_replay_corrects_negative_amounts_only(spark, rows):
    schema = "order_id bigint, amount double"
    bad = spark.createDataFrame([(9901, -500.0, "NEGATIVE_AMOUNT"), (9902, 1200.0, "MISSING_PK"), (9903, None, "NEGATIVE_AMOUNT")], schema + ", reason_code string")
    dlq = routing.quarantine(bad, run_id="r", pipeline_id="p002", run_ts="2024-06-01 00:00:00", details="d")
    assert rows(routing.corrected_negatives(dlq, schema, "amount")) == [(9901, 500.0)]


@pytest.mark.parametrize("mask, value, expected", [
    (privacy.mask_email_short, "aarav@example.com", "a***@example.com"),
    (privacy.mask_email_short, "a@b@c", "***@example.com"),
    (privacy.mask_email_short, "@domain", "***@domain"),
    (privacy.mask_email_short, None, "***@example.com"),
    (privacy.mask_email_prefix, "rahul@domain.com", "ra***@domain.com"),
    (privacy.mask_email_prefix, "ab@c@d", "ab***@c@d"),
    (privacy.mask_email_prefix, "none", "***@masked.com"),
    (privacy.mask_email_ends, "customer.pii@example.com", "c***i@example.com"),
    (privacy.mask_phone_short, "+919876543210", "******3210"),
    (privacy.mask_phone_short, "12", "******"),
    (privacy.mask_phone_national, "+919876543210", "+91XXXXXX3210"),
    (privacy.mask_phone_national, None, "+91XXXXXXXXXX"),
])
def test_masks(spark, mask, value, expected):
    assert spark.createDataFrame([(value,)], "v string").select(mask("v")).first()[0] == expected


def test_contract_accepts_two_good_rows_and_finds_bad_ones(spark):
    rules = [
        Rule("id_positive", "gt", "customer_id", (0,)), Rule("name_present", "not_null", "first_name"),
        Rule("email_has_at", "contains", "email", ("@",)), Rule("spend_not_negative", "min", "total_spend", (0,)),
        Rule("id_unique", "unique", "customer_id"),
    ]
    schema = "customer_id bigint, first_name string, email string, total_spend double"
    good = spark.createDataFrame([(1, "Aarav", "aarav@example.com", 1500.0), (2, "Diya", "diya@example.com", 2400.5)], schema)
    quality.require_pass(quality.evaluate(good, rules))
    bad = spark.createDataFrame([(0, None, "x", -1.0), (0, "Diya", "d@e", 1.0)], schema)
    failed = {r["check_name"]: r["failed_count"] for r in quality.evaluate(bad, rules).collect()}
    assert failed == {"id_positive": 2, "name_present": 1, "email_has_at": 1, "spend_not_negative": 1, "id_unique": 1}
    with pytest.raises(GateClosed):
        quality.require_pass(quality.evaluate(bad, rules))


def test_missing_column_halts_the_run(spark):
    orders = spark.createDataFrame([(1, 2, 5.0)], "order_id bigint, customer_id bigint, total_amount double")
    verdict = quality.gate(quality.check_contract(orders, Contract.from_spec("orders", CONTRACTS["orders"]))).first()
    assert verdict["verdict"] == "HALT_RUN" and verdict["failed_schema_checks"] == 2


def test_closed_gate_leaves_the_published_version(spark, sf):
    from sedimenta.plans import warehouse
    from sedimenta.plans.quality import publish_daily_sales
    from sedimenta.session import scratch_path
    from sedimenta.sources.tables import VersionedTable

    table = VersionedTable(spark, scratch_path(spark, "gold"))
    silver = warehouse.silver_orders(spark, sf)
    publish_daily_sales(silver, table, "good")
    with pytest.raises(GateClosed):
        publish_daily_sales(silver.withColumn("total_amount", -F.col("total_amount")), table, "bad")
    assert table.current()["run_id"] == "good"


def test_drift_of_one_event_spoils_no_other(spark, rows):
    events = spark.createDataFrame([
        (49, '{"event_id":"evt_0049","user_id":7}'),
        (50, '{"event_id":"evt_0050","user_id":"user_str_99","new_unannounced_field":"x"}'), (51, '{"user_id":1}'),
    ], "n int, payload string")
    out = quality.schema_drift(events, "n", "payload", {"event_id": "string", "user_id": "bigint"}).drop("payload")
    assert rows(out) == [(50, "new_unannounced_field", "", "user_id"), (51, "", "event_id", "")]


def test_golden_compare_counts_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert tuple(regression.compare_to_golden(a, b).first()) == (3, 3, 1, 1, "FAILED")
    assert regression.compare_to_golden(a, a).first()["status"] == "PASSED"


def test_erasure_unlinks_without_changing_totals(spark):
    people = spark.createDataFrame([(1, "a@b", 5), (2, "c@d", 7)], "customer_id bigint, email string, spend int")
    stored, tokens = vault.split_vault(people, "customer_id", ["email"], "pepper")
    left = vault.erase(stored, spark.createDataFrame([(1,)], "customer_id bigint"), "customer_id")
    assert [r["email"] for r in left.collect()] == ["c@d"]
    assert "email" not in tokens.columns and tokens.agg(F.sum("spend")).first()[0] == 12


def test_encryption_differs_per_row_and_decrypts(spark):
    df = spark.createDataFrame([("a@b",), ("a@b",)], "email string")
    stored = df.select(privacy.encrypt("email", "0" * 32).alias("c"))
    assert {r[0] for r in stored.select(privacy.decrypt("c", "0" * 32)).collect()} == {"a@b"}


def test_rules_over_several_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 3, -1), (None, None, None)], "a int, b int, c int")
    found = {r.check_name: r.failed_count for r in quality.evaluate(df, [
        Rule("present", "all_present", None, ("a", "b")), Rule("range", "none_where", None, ("c < 0 OR b > 2",))]).collect()}
    assert found == {"present": 2, "range": 1}


def test_totals_beyond_a_single_amount(spark):
    from sedimenta.operators import gold

    daily = spark.createDataFrame([(1, 1e13), (1, 2.5), (2, 9e12)], "store_id int, total_revenue double")
    assert [tuple(r) for r in gold.top_stores(daily, 2).collect()] == [(1, 10_000_000_000_002.5), (2, 9e12)]


def test_masking_of_addresses_and_numbers(spark):
    df = spark.createDataFrame([(1, "Street 1, Pune", "123"), (2, "nowhere", None), (3, None, "123")], "id int, delivery_address string, ssn string")
    with pytest.raises(ValueError):
        vault.mask_configured(df, ["ssn"])
    got = {r.id: (r.delivery_address, r.ssn) for r in vault.mask_configured(df, ["ssn", "delivery_address", "gone"], "p").collect()}
    assert [got[i][0] for i in (1, 2, 3)] == ["***, Pune", "***", None]
    assert got[1][1] == got[3][1] and len(got[1][1]) == 64 and "123" not in got[1][1]
    other = vault.mask_configured(df, ["ssn"], "q").first()["ssn"]
    assert other != got[1][1]
