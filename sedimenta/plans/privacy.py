"""K: masking, tokens, vault and encryption."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import privacy
from sedimenta.operators import vault
from sedimenta.plans import warehouse
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import materialise, scratch_path
from sedimenta.sources import entities


def pepper(spark) -> str:
    """The secret of the tokens, from configuration; the default serves the checks only."""
    return spark.conf.get("spark.sedimenta.pepper", "check-pepper")


@query("K1_mask_email_short", expect("""
SELECT customer_id, CASE WHEN email LIKE '%@%' THEN substr(email, 1, 1) || '***@example.com' ELSE '***@example.com' END AS masked_email
FROM customers""", "customers"))
def _(spark, sf):
    return entities.customers(spark, sf).select("customer_id", privacy.mask_email_short("email").alias("masked_email"))


@query("K2_mask_phone_short", expect("""
SELECT customer_id, CASE WHEN balance < 0 THEN '******' ELSE '******' || right(phone, 4) END AS masked_phone FROM customers""", "customers"))
def _(spark, sf):
    # Customers in debt left a three-digit extension instead of a number.
    phone = F.when(F.col("balance") < 0, F.right("phone", F.lit(3))).otherwise(F.col("phone"))
    return entities.customers(spark, sf).withColumn("phone", phone).select(
        "customer_id", privacy.mask_phone_short("phone").alias("masked_phone")
    )


@query("K3_hash_email", expect("SELECT customer_id, sha256(email) AS email_hash FROM customers", "customers"))
def _(spark, sf):
    return entities.customers(spark, sf).select("customer_id", privacy.sha256("email").alias("email_hash"))


@query("K4_mask_email_prefix", expect("""
SELECT customer_id, CASE WHEN email LIKE '%@%' THEN substr(email, 1, 2) || '***@' || substr(email, instr(email, '@') + 1)
  ELSE '***@masked.com' END AS masked_email
FROM (SELECT customer_id, CASE WHEN segment = 'BUILDING' THEN email || '@relay' ELSE email END AS email FROM customers)""", "customers"))
def _(spark, sf):
    # One segment uses relay addresses, which hold a second @ once the first is valid.
    relayed = F.when(F.col("segment") == "BUILDING", F.concat("email", F.lit("@relay"))).otherwise(F.col("email"))
    return entities.customers(spark, sf).withColumn("email", relayed).select(
        "customer_id", privacy.mask_email_prefix("email").alias("masked_email")
    )


@query("K5_mask_phone_national", expect("""
SELECT customer_id, CASE WHEN balance < 0 THEN '+91XXXXXXXXXX' ELSE '+91XXXXXX' || right(phone, 4) END AS masked_phone FROM customers""", "customers"))
def _(spark, sf):
    phone = F.when(F.col("balance") < 0, F.right("phone", F.lit(3))).otherwise(F.col("phone"))
    return entities.customers(spark, sf).withColumn("phone", phone).select(
        "customer_id", privacy.mask_phone_national("phone").alias("masked_phone")
    )


@query("K6_mask_email_ends", expect("""
SELECT customer_id, CASE WHEN email LIKE '%@%' THEN substr(email, 1, 1) || '***' || right(split_part(email, '@', 1), 1) || '@example.com'
  ELSE '***@example.com' END AS masked_email FROM customers""", "customers"))
def _(spark, sf):
    return entities.customers(spark, sf).select("customer_id", privacy.mask_email_ends("email").alias("masked_email"))


@query("K7_peppered_token", expect("""
SELECT customer_id, sha256(CAST(customer_id AS VARCHAR) || '_check-pepper') AS customer_token FROM customers""", "customers"))
def _(spark, sf):
    return entities.customers(spark, sf).select(
        "customer_id", privacy.peppered_token("customer_id", pepper(spark)).alias("customer_token")
    )


def _vaulted(spark, sf):
    source = entities.customers(spark, sf).select("customer_id", "email", "phone", "state", "balance")
    return vault.split_vault(source, "customer_id", ["email", "phone"], pepper(spark))


@query("K8_vault_after_erasure", expect("""
SELECT customer_id, email, phone FROM customers WHERE customer_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""", "customers"))
def _(spark, sf):
    stored, _tokens = _vaulted(spark, sf)
    requests = entities.events(spark, sf).where(F.col("event_type") == "error").select(F.col("user_id").alias("customer_id"))
    return vault.erase(stored, requests, "customer_id").select("customer_id", "email", "phone")


@query("K8_aggregates_survive_erasure", expect("""
SELECT state, count(*) AS customer_count, CAST(sum(CAST(balance AS DECIMAL(14,2))) AS DOUBLE) AS balance,
       count(*) FILTER (customer_id IN (SELECT user_id FROM events WHERE event_type = 'error')) AS unlinkable
FROM customers GROUP BY state""", "customers"))
def _(spark, sf):
    stored, tokens = _vaulted(spark, sf)
    requests = entities.events(spark, sf).where(F.col("event_type") == "error").select(F.col("user_id").alias("customer_id"))
    left = vault.erase(stored, requests, "customer_id").select("customer_id_token", F.lit(1).alias("_linked"))
    return tokens.join(left, "customer_id_token", "left").groupBy("state").agg(
        F.count("*").alias("customer_count"),
        F.sum(F.col("balance").cast("decimal(14,2)")).cast("double").alias("balance"),
        F.count(F.when(F.col("_linked").isNull(), 1)).alias("unlinkable"),
    )


@query("K8_random_tokens_after_erasure", expect("""
SELECT state, count(*) AS customer_count, CAST(sum(CAST(balance AS DECIMAL(14,2))) AS DOUBLE) AS balance,
       count(*) FILTER (customer_id IN (SELECT user_id FROM events WHERE event_type = 'error')) AS unlinkable,
       count(*) AS tokens, 0::BIGINT AS derivable, 0::BIGINT AS changed
FROM customers GROUP BY state""", "customers"))
def _(spark, sf):
    source = entities.customers(spark, sf).select("customer_id", "email", "phone", "state", "balance")
    persons = source.select("customer_id", "email", "phone")
    stored = vault.TokenVault(spark, scratch_path(spark, "vault"), "customer_id", persons.schema)
    stored.assign(persons.where(F.col("customer_id") % 2 == 0), "even")
    early = materialise(stored.read().select("customer_id", F.col("customer_id_token").alias("_early")), "early")
    stored.assign(persons, "all")  # those that are stored keep their tokens
    tokened = materialise(stored.tokenise(source), "tokened")
    moved = materialise(
        stored.read().join(early, "customer_id").where(F.col("_early") != F.col("customer_id_token")).select("customer_id_token"), "moved")
    requests = entities.events(spark, sf).where(F.col("event_type") == "error").select(F.col("user_id").alias("customer_id"))
    stored.erase(requests, "requests")
    left = stored.read().select("customer_id_token", F.lit(1).alias("_linked"))
    # Who knows all keys and the pepper can compute the derived tokens; none of them is in use.
    derived = source.select(privacy.peppered_token("customer_id", pepper(spark)).alias("customer_id_token"), F.lit(1).alias("_derived"))
    found = tokened.join(left, "customer_id_token", "left").join(derived, "customer_id_token", "left").join(
        moved.withColumn("_moved", F.lit(1)), "customer_id_token", "left")
    return found.groupBy("state").agg(
        F.count("*").alias("customer_count"),
        F.sum(F.col("balance").cast("decimal(14,2)")).cast("double").alias("balance"),
        F.count(F.when(F.col("_linked").isNull(), 1)).alias("unlinkable"),
        F.countDistinct("customer_id_token").alias("tokens"), F.count("_derived").alias("derivable"), F.count("_moved").alias("changed"),
    )


@query("K9_minimise_columns", expect("""
SELECT customer_id, city, state, effective_date, is_current, version FROM dim_customer""", "dim_customer"))
def _(spark, sf):
    return vault.minimise(
        warehouse.dim_customer(spark, sf), ["customer_id", "city", "state", "effective_date", "is_current", "version"]
    )


@query("K10_encryption_round_trip", expect("""
SELECT customer_id, email AS decrypted, 1 AS is_unreadable FROM customers""", "customers"))
def _(spark, sf):
    key = spark.conf.get("spark.sedimenta.aesKey", "0123456789abcdef0123456789abcdef")
    stored = entities.customers(spark, sf).select("customer_id", "email", privacy.encrypt("email", key).alias("cipher"))
    return stored.select(
        "customer_id", privacy.decrypt("cipher", key).alias("decrypted"),
        F.when(F.col("cipher") != F.col("email"), 1).otherwise(0).alias("is_unreadable"),
    )
