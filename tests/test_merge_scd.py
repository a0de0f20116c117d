"""Merging and history."""

import datetime

from pyspark.sql import functions as F

from sedimenta.operators import merge, scd

DIM = "customer_id bigint, city string, effective_date date, expiry_date date, is_current int, version bigint"
D = datetime.date


def test_upsert_order_one_is_idempotent(spark, rows):
    schema = "order_id bigint, status string, amount double, note string, seq bigint"
    target = spark.createDataFrame([(1, "PENDING", 10.0, "kept", 0), (2, "PENDING", 20.0, "other", 0)], schema)
    batch = spark.createDataFrame([(1, "DELIVERED", 1500.0, "ignored", 1), (3, "NEW", 1.0, "first", 1), (3, "OLD", None, "second", 2)], schema)
    update = ["status", "amount", "seq"]
    once = merge.upsert(target, batch, ["order_id"], update, ["seq"])
    expected = [(1, "DELIVERED", 1500.0, "kept", 1), (2, "PENDING", 20.0, "other", 0), (3, "OLD", None, "first", 2)]
    assert rows(once) == expected
    assert rows(merge.upsert(once, batch, ["order_id"], update, ["seq"])) == expected


def test_replace_and_insert_absent(spark, rows):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k bigint, v string, seq int")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k bigint, v string, seq int")
    assert rows(merge.replace_rows(target, batch, ["k"], ["seq"])) == [(1, "a", 0), (2, "d", 2), (3, "e", 1)]
    assert rows(merge.insert_absent(target, batch.where("seq = 1"), ["k"])) == [(1, "a", 0), (2, "b", 0), (3, "e", 1)]


def test_scd1_corrects_a_name_and_keeps_the_version(spark, rows):
    dim = spark.createDataFrame([(801, "Rahl", 1), (802, "Priya", 1)], "customer_id bigint, first_name string, version int")
    fix = spark.createDataFrame([(801, "Rahul", 1)], "customer_id bigint, first_name string, seq int")
    assert rows(scd.overwrite(dim, fix, "customer_id", ["first_name"], ["seq"])) == [(801, "Rahul", 1), (802, "Priya", 1)]


def test_scd2_move_gives_two_versions(spark, rows):
    dim = spark.createDataFrame([(802, "Bengaluru", D(2024, 1, 1), None, 1, 1)], DIM)
    moved = spark.createDataFrame([(802, "Pune", 1), (802, "Mumbai", 2), (900, "Delhi", 1)], "customer_id bigint, city string, seq int")
    out = scd.merge_history(dim, moved, "customer_id", ["city"], "2024-06-01", ["seq"])
    expected = [
        (802, "Bengaluru", D(2024, 1, 1), D(2024, 6, 1), 0, 1),
        (802, "Mumbai", D(2024, 6, 1), None, 1, 2),
        (900, "Delhi", D(2024, 6, 1), None, 1, 1),
    ]
    assert rows(out) == sorted(expected, key=repr)
    again = scd.merge_history(out, moved, "customer_id", ["city"], "2024-07-01", ["seq"], detect_changes=True)
    assert rows(again) == rows(out)
    assert {r["violation_count"] for r in scd.validate_history(out, "customer_id").collect()} == {0}


def test_scd3_keeps_the_previous_category(spark, rows):
    schema = "product_id bigint, category string, previous_category string"
    dim = spark.createDataFrame([(901, "Eyewear", None), (902, "Eyewear", None), (903, "Eyewear", None)], schema)
    changes = spark.createDataFrame([(901, "Wearable Tech", 1), (902, "Eyewear", 1)], "product_id bigint, category string, seq int")
    out = scd.shift_previous(dim, changes, "product_id", "category", "previous_category", ["seq"])
    assert rows(out) == [(901, "Wearable Tech", "Eyewear"), (902, "Eyewear", None), (903, "Eyewear", None)]


def test_as_of_lookup_is_half_open(spark, rows):
    history = spark.createDataFrame([
        (1, "A", D(2024, 1, 1), D(2024, 6, 1), 0, 1), (1, "B", D(2024, 6, 1), D(2024, 9, 1), 0, 2),
        (2, "Z", D(2024, 3, 1), None, 1, 1),
    ], DIM)
    facts = spark.createDataFrame(
        [(10, 1, D(2023, 12, 31)), (11, 1, D(2024, 5, 31)), (12, 1, D(2024, 6, 1)), (13, 1, D(2024, 9, 1)), (14, 2, D(2025, 1, 1)), (15, 3, D(2024, 1, 1))],
        "fact_id bigint, customer_id bigint, day date",
    )
    out = scd.as_of_lookup(facts, history, "customer_id", "day", ["city"], ["fact_id"], buckets=4)
    assert rows(out.select("fact_id", "city")) == [(10, None), (11, "A"), (12, "B"), (13, None), (14, "Z"), (15, None)]


def test_hot_key_history_equals_plain(spark, rows):
    log = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("effective_date"), F.col("id").alias("change_id"),
    )
    history = scd.rebuild_history(log, "customer_id", "effective_date", ["change_id"], buckets=16)
    assert {r["violation_count"] for r in scd.validate_history(history, "customer_id").collect()} == {0}
    assert history.count() == 400
