"""Warehouse tables built from the entities, shared by the queries."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.dates import calendar
from sedimenta.functions.keys import number_key
from sedimenta.operators import gold, star
from sedimenta.sources import entities
from sedimenta.sources.readers import table

CONFIG = Path(__file__).resolve().parents[2] / "config"
LOAD_DATE = "2024-01-01"


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return gold.silver_orders(entities.source_orders(spark, sf))


def dim_customer(spark: SparkSession, sf: str, everyone: bool = False) -> DataFrame:
    """Customers with a balance in order; the others have not arrived yet unless ``everyone``."""
    source = entities.customers(spark, sf)
    arrived = source if everyone else source.where(F.col("balance") >= 0)
    rows = arrived.withColumn("effective_date", F.lit(LOAD_DATE).cast("date")).select(
        number_key("customer_id", "effective_date").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "email", "city", "state", "effective_date",
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(1).alias("is_current"), F.lit(1).cast("bigint").alias("version"),
    )
    return star.seeded(rows, star.UNKNOWN_CUSTOMER)


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    rows = entities.products(spark, sf).withColumn("effective_date", F.lit(LOAD_DATE).cast("date")).select(
        number_key("product_id", "effective_date").alias("product_sk"),
        "product_id", "product_name", "category", F.col("price").alias("current_price"),
        F.lit(None).cast("string").alias("previous_category"), "effective_date", F.lit(1).alias("is_current"),
    )
    return star.seeded(rows, star.UNKNOWN_PRODUCT)


def dim_store(spark: SparkSession, sf: str) -> DataFrame:
    rows = entities.stores(spark, sf).select((F.col("store_id") + 1).alias("store_sk"), "*")
    return star.seeded(rows, star.UNKNOWN_STORE)


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """All days of the years in which orders were placed."""
    bounds = table(spark, sf, "orders").agg(
        F.trunc(F.min("o_orderdate").cast("date"), "year").alias("first_day"),
        F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("last_day"),
    )
    return calendar(bounds, "first_day", "last_day")


def facts(spark: SparkSession, sf: str, *dims: str, loaded: DataFrame | None = None) -> DataFrame:
    """The order line facts with the keys of the named dimensions, of all three by default."""
    build = {"customers": dim_customer, "products": dim_product, "stores": dim_store}
    return star.load_facts(
        entities.order_items(spark, sf), entities.source_orders(spark, sf), loaded=loaded,
        **{d: build[d](spark, sf) for d in dims or build},
    )


def order_facts(spark: SparkSession, sf: str, *dims: str) -> DataFrame:
    """The facts at order grain with the keys of the named dimensions, none by default."""
    build = {"customers": dim_customer, "stores": dim_store}
    orders = entities.source_orders(spark, sf) if "stores" in dims else entities.order_headers(spark, sf)
    return star.load_order_facts(entities.order_items(spark, sf), orders, **{d: build[d](spark, sf) for d in dims})


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Address changes: the first address, and a new one with each day's last order."""
    first = entities.customers(spark, sf).select(
        "customer_id", F.lit("1900-01-01").cast("date").alias("effective_date"), "city",
        F.lit(-1).cast("bigint").alias("change_id"),
    )
    moves = entities.order_headers(spark, sf).groupBy("customer_id", F.col("created_at").cast("date").alias("effective_date")).agg(
        F.max("order_id").alias("change_id")
    )
    city = F.concat(F.lit("CITY_"), (F.col("change_id") % 25).cast("string"))
    return first.unionByName(moves.withColumn("city", city))


def audit(spark: SparkSession, sf: str) -> DataFrame:
    """Run audit derived from the event stream: one run per event type and day.

    Values below one count as rejected; values above two hundred as lost on the way.
    """
    low, usual = F.col("value") < 1, F.col("value").between(1, 200)
    runs = entities.events(spark, sf).groupBy(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
    ).agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count("*").alias("records_extracted"),
        F.count(F.when(usual, 1)).alias("records_loaded"),
        F.count(F.when(low, 1)).alias("records_rejected"),
    )
    return runs.withColumn(
        "status",
        F.when(F.col("records_rejected") * 100 > F.col("records_extracted") * 3, "FAILED").otherwise("SUCCESS"),
    )


def dim_prescription(spark: SparkSession, sf: str) -> DataFrame:
    """The prescription dimension with a deterministic key over the identifying columns of a line."""
    identity = ["order_id", "product_id", "partner_id", "line_number", "quantity", "unit_price", "discount", "tax"]
    lenses = entities.products(spark, sf).select("product_id", F.col("category").alias("lens_type"))
    rows = entities.order_items(spark, sf).join(lenses, "product_id").select(
        number_key(*identity).alias("prescription_sk"), F.col("order_id").alias("prescription_id"), "lens_type"
    )
    return star.seeded(rows, star.UNKNOWN_PRESCRIPTION)


def prescriptions(spark: SparkSession, sf: str) -> DataFrame:
    """One prescription per order line: lens type from the product, four measures from the line."""
    items = entities.order_items(spark, sf)
    owners = entities.order_headers(spark, sf).select("order_id", "customer_id")
    lenses = entities.products(spark, sf).select("product_id", F.col("category").alias("lens_type"))
    return items.join(owners, "order_id").join(lenses, "product_id").select(
        F.col("product_id").alias("prescription_sk"), "customer_id", "lens_type",
        F.col("quantity").alias("sphere_left"), F.col("discount").alias("sphere_right"),
        F.col("tax").alias("cylinder_left"), F.col("unit_price").alias("cylinder_right"),
    )
