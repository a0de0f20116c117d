"""Distributed windows against plain ones."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sedimenta.operators import ordered
from sedimenta.session import materialise

CALLS = {
    "rn": ordered.row_number(), "rk": ordered.rank(), "dr": ordered.dense_rank(), "nt": ordered.ntile(4),
    "rs": ordered.running_sum("v"), "lg": ordered.lag("v"), "ld": ordered.lead("v"), "cf": ordered.carry_forward("v"),
}


def plain(df, parts, direction):
    key = F.desc("o") if direction == "desc" else F.asc("o")
    values = Window.partitionBy(*(parts or [F.lit(0)])).orderBy(key)
    w = Window.partitionBy(*(parts or [F.lit(0)])).orderBy(key, "id")
    here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "*", F.row_number().over(w).cast("bigint").alias("rn"), F.rank().over(values).cast("bigint").alias("rk"),
        F.dense_rank().over(values).cast("bigint").alias("dr"), F.ntile(4).over(w).cast("bigint").alias("nt"),
        F.sum("v").over(here).alias("rs"), F.lag("v").over(w).alias("lg"), F.lead("v").over(w).alias("ld"),
        F.last("v", ignorenulls=True).over(here).alias("cf"),
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key and in one ordering value; NULLs everywhere but in the id."""
    rng = random.Random(5)

    def one(i):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        order = 7 if rng.random() < 0.34 else rng.choice([None, *range(20)])
        return (i, key, order, rng.choice([None, *range(9)]))

    return materialise(spark.createDataFrame([one(i) for i in range(900)], "id bigint, k string, o int, v bigint"), "skewed")


@pytest.mark.parametrize("parts", [[], ["k"]])
@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("buckets", [1, 8, 45])
def test_equals_plain_window(skewed, parts, direction, buckets):
    actual = ordered.ordered_window(
        skewed, CALLS, partition_by=parts, order_by=[("o", direction)], tiebreak=["id"], buckets=buckets
    )
    expected = plain(skewed, parts, direction).select(*actual.columns)
    assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))


def test_buckets_split_the_hot_key(skewed):
    """No bucket of the hot key holds more than a small share of its rows."""
    layout = ordered._bucketed(skewed, ["k"], [("o", "asc")], ["id"], 16)
    sizes = [r["count"] for r in layout.df.where(F.col("k") == "hot").groupBy("_bucket").count().collect()]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


def test_carry_is_bounded_by_the_buckets(skewed):
    layout = ordered._bucketed(skewed, ["k"], [("o", "asc")], ["id"], 16)
    assert ordered._carry(layout, CALLS).count() <= 2 * 16


def test_types_in_the_sort_key(spark):
    df = materialise(spark.range(300).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("d"),
        F.timestamp_seconds(F.col("id") % 11).alias("t"),
        F.timestamp_seconds(F.col("id") % 11).cast("timestamp_ntz").alias("n"),
        (F.col("id") % 5).cast("decimal(9,2)").alias("m"), F.concat(F.lit('q"\\'), (F.col("id") % 3).cast("string")).alias("s"),
    ), "typed")
    order = [("d", "desc"), ("t", "asc"), ("n", "asc"), ("m", "desc"), ("s", "asc")]
    out = ordered.ordered_window(df, {"rn": ordered.row_number()}, order_by=order, tiebreak=["id"], buckets=20)
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("d"), "t", "n", F.desc("m"), "s", "id")
    wrong = out.withColumn("plain", F.row_number().over(w)).where("rn <> plain")
    assert wrong.count() == 0


def test_a_type_without_order_is_refused(skewed):
    with pytest.raises(TypeError):
        ordered.ordered_window(
            skewed.withColumn("k", F.array("k")), {"rn": ordered.row_number()}, order_by=[("k", "desc")], tiebreak=["id"])


def test_empty_frame(skewed):
    out = ordered.ordered_window(skewed.where("id < 0"), CALLS, order_by=[("o", "asc")], tiebreak=["id"])
    assert out.count() == 0


TYPED = {
    "boolean": [True, False], "bigint": [-(2**63), -1, 0, 7, 2**63 - 1], "int": [-(2**31), 0, 2**31 - 1],
    "double": [float("-inf"), -1.5, -0.0, 0.0, 2.0, float("inf"), float("nan")], "decimal(20,2)": ["-99.10", "0", "12345678901234567.89"],
    "string": ["", "a", "ab", "b", "é", "\U0001f600", "a\x00", "Z"], "binary": ["", "a", "ab", "\x7f"],
    "date": ["0001-01-01", "1969-12-31", "2024-02-29"], "timestamp": ["1969-12-31 23:59:59.999999", "2024-03-31 01:30:00"],
    "timestamp_ntz": ["0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2024-03-31 02:30:00", "2024-03-31 02:30:00.000001"],
}


@pytest.mark.parametrize("dtype", sorted(TYPED))
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_every_type_in_both_directions(spark, dtype, direction):
    rng = random.Random(9)
    plain_type = {"boolean": "boolean", "bigint": "bigint", "int": "int", "double": "double"}.get(dtype, "string")
    rows = [(i, rng.choice(["hot", "hot", "k"]), rng.choice([None, *TYPED[dtype]])) for i in range(150)]
    df = spark.createDataFrame(rows, f"id bigint, k string, o {plain_type}").withColumn("o", F.col("o").cast(dtype))
    df = materialise(df, "typed")
    calls = {"rn": ordered.row_number(), "rk": ordered.rank(), "dr": ordered.dense_rank(), "lg": ordered.lag("id")}
    actual = ordered.ordered_window(df, calls, partition_by=["k"], order_by=[("o", direction)], tiebreak=["id"], buckets=13)
    key = F.desc("o") if direction == "desc" else F.asc("o")
    w = Window.partitionBy("k").orderBy(key, "id")
    by_value = Window.partitionBy("k").orderBy(key)
    expected = df.select(
        "*", F.row_number().over(w).cast("bigint").alias("rn"), F.rank().over(by_value).cast("bigint").alias("rk"),
        F.dense_rank().over(by_value).cast("bigint").alias("dr"), F.lag("id").over(w).alias("lg"))
    assert sorted(map(repr, actual.drop("o").collect())) == sorted(map(repr, expected.drop("o").collect()))


def test_two_descending_columns(spark, rows):
    df = materialise(spark.createDataFrame([(1, "b", "x"), (2, "a", "xy"), (3, "a", "x"), (4, None, "z")], "id int, p string, q string"), "two")
    got = ordered.ordered_window(df, {"n": ordered.row_number()}, order_by=[("p", "desc"), ("q", "desc")], tiebreak=["id"], buckets=3)
    assert rows(got.select("n", "id")) == [(1, 1), (2, 2), (3, 3), (4, 4)]
