"""Business aggregates of the gold layer.

``order_facts`` have one row per order with lines (`star.load_order_facts`, `star.to_order_grain`), so
counting rows counts distinct orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.dates import order_date
from sedimenta.functions.money import money, ratio, sum_exact, sum_money, sum_totals


def silver_orders(orders: DataFrame) -> DataFrame:
    """Usable orders with their order date."""
    usable = orders.where(F.col("order_id").isNotNull() & (F.col("total_amount") >= 0))
    return usable.withColumn("order_date", order_date("created_at"))


def daily_sales(orders: DataFrame) -> DataFrame:
    """Sales per day and store. The average counts undelivered orders as zero; the average over
    delivered orders alone stands next to it."""
    delivered = F.col("order_status") == "DELIVERED"
    amount = F.when(delivered, money("total_amount")).otherwise(F.lit(0).cast("decimal(14,2)"))
    sums = orders.groupBy(F.col("order_date").alias("summary_date"), "store_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count(F.when(delivered, 1)).alias("successful_orders"),
        F.sum(amount).alias("_revenue"),
    )
    return sums.select(
        "summary_date", "store_id", "total_orders", "successful_orders",
        F.col("_revenue").cast("double").alias("total_revenue"),
        ratio(F.col("_revenue"), F.col("total_orders")).alias("avg_order_value"),
        F.when(F.col("successful_orders") > 0, ratio(F.col("_revenue"), F.col("successful_orders")))
        .alias("avg_delivered_value"),
    )


def daily_store_sales(order_facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Aggregates before the store names are joined; equal to joining first, on far fewer rows."""
    sums = order_facts.groupBy("date_key", "store_sk").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
        sum_exact("total_price").alias("gross_revenue"),
        sum_exact("net_amount").alias("net_revenue"),
    )
    return sums.join(stores.select("store_sk", "store_name", "state"), "store_sk").select(
        "date_key", "store_sk", "store_name", "state", "total_orders", "total_items_sold",
        "gross_revenue", "net_revenue",
    )


def executive_kpi(order_facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly totals. ``average_order_value`` is the average per line, as the name's owner defined
    it; ``revenue_per_order`` is the average per order."""
    daily = order_facts.groupBy("date_key").agg(
        F.count("order_id").alias("_orders"), F.sum("line_count").alias("_lines"), F.sum("quantity").alias("_units"),
        F.sum("total_price").alias("_gmv"), F.sum("discount_amount").alias("_discounts"), F.sum("net_amount").alias("_net"),
    )
    monthly = daily.join(dates.select("date_key", "year", "month", "month_name"), "date_key")
    sums = monthly.groupBy("year", "month", "month_name").agg(
        F.sum("_orders").alias("total_orders"), F.sum("_units").alias("total_units_sold"),
        *[F.sum(c).alias(c) for c in ("_lines", "_gmv", "_discounts", "_net")],
    )

    def cents(total: str):
        return F.round(total, 2).cast("double")

    return sums.select(
        "year", "month", "month_name", "total_orders", "total_units_sold",
        cents("_gmv").alias("gmv"), cents("_discounts").alias("total_discounts"), cents("_net").alias("net_revenue"),
        F.round(ratio(F.col("_net"), F.col("_lines")), 2).alias("average_order_value"),
        F.round(ratio(F.col("_net"), F.col("total_orders")), 2).alias("revenue_per_order"),
    ).orderBy(F.desc("year"), F.desc("month"))


def customer_spend(order_facts: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Lines, spend and last date per customer; ``total_orders`` counts lines.

    Facts are aggregated by surrogate key before names are joined, so a hot customer is combined
    map-side. The date key orders like the date, so the calendar is joined once per customer.
    """
    sums = order_facts.groupBy("customer_sk").agg(
        F.sum("line_count").alias("_lines"),
        F.sum("net_amount").alias("_spend"),
        F.max("date_key").alias("_last"),
    )
    named = sums.join(customers, "customer_sk").join(
        dates.select(F.col("date_key").alias("_last"), "full_date"), "_last"
    )
    return named.groupBy("customer_id", "first_name", "last_name", "city").agg(
        F.sum("_lines").alias("total_orders"),
        F.sum("_spend").alias("total_spend"),
        F.max("full_date").alias("last_order_date"),
    ).select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"), "city",
        "total_orders", "total_spend", "last_order_date",
    )


def customer_lifetime(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        sum_money("total_amount").alias("lifetime_spend"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def prescription_trends(prescriptions: DataFrame, customers: DataFrame) -> DataFrame:
    """Prescriptions by customer state and lens type with four averages.

    Sums per customer come first: the customer join then sees one row per customer and lens type.
    """
    measures = ["sphere_left", "sphere_right", "cylinder_left", "cylinder_right"]
    per_customer = prescriptions.groupBy("customer_id", "lens_type").agg(
        F.count("prescription_sk").alias("_n"), *[F.sum(m).alias(m) for m in measures]
    )
    current = customers.where(F.col("is_current") == 1).select("customer_id", "state")
    sums = per_customer.join(current, "customer_id").groupBy("state", "lens_type").agg(
        F.sum("_n").alias("total_prescriptions"), *[F.sum(m).alias(m) for m in measures]
    )
    averages = [F.round(ratio(F.col(m), F.col("total_prescriptions")), 2).alias(f"avg_{m}") for m in measures]
    return sums.select("state", "lens_type", "total_prescriptions", *averages).orderBy(
        F.desc("total_prescriptions"), "state", "lens_type"
    )


def rfm(orders: DataFrame) -> DataFrame:
    """Frequency, monetary value and latest date; orders without a customer are left out."""
    return orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("order_id").alias("frequency"),
        F.sum(money("total_amount")).alias("monetary"),
        F.max("order_date").alias("recency_latest_date"),
    )


def top_products(facts: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """Best-selling product names of each category; Catalyst limits the groups before the shuffle."""
    per_product = facts.groupBy("product_sk").agg(F.sum("quantity").alias("_qty"))
    sales = per_product.join(products, "product_sk").groupBy("category", "product_name").agg(
        F.sum("_qty").alias("total_qty")
    )
    w = Window.partitionBy("category").orderBy(F.desc("total_qty"), "product_name")
    return sales.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= n).withColumn(
        "rnk", F.col("rnk").cast("bigint")
    )


def monthly_orders(order_facts: DataFrame) -> DataFrame:
    """Orders per customer and month with the neighbouring active months.

    A customer has at most one row per calendar month here, which bounds the window group.
    """
    monthly = order_facts.where(F.col("customer_sk") != -1).groupBy(
        "customer_sk", F.expr("date_key div 100").cast("int").alias("order_month")
    ).agg(F.count("order_id").alias("month_orders"))
    w = Window.partitionBy("customer_sk").orderBy("order_month")
    return monthly.withColumns({
        "prev_month_orders": F.lag("month_orders").over(w),
        "next_month_orders": F.lead("month_orders").over(w),
    })


def top_stores(daily: DataFrame, n: int) -> DataFrame:
    return (
        daily.groupBy("store_id")
        .agg(sum_totals("total_revenue").alias("gross_revenue"))
        .orderBy(F.desc("gross_revenue"), "store_id")
        .limit(n)
    )


def activity_rollup(activity: DataFrame, keys: list[str]) -> DataFrame:
    """Attempts, best score, latest status and topics per key."""
    latest = F.max_by(F.struct("status", "weak_topics"), F.struct("ts", "event_id"))
    return activity.groupBy(*keys).agg(
        F.count("*").alias("attempts"), F.max("score").alias("score"), latest.alias("_l")
    ).select(*keys, "attempts", "score", F.col("_l.status").alias("status"), F.col("_l.weak_topics").alias("weak_topics"))


def activity_summary(rollup: DataFrame) -> DataFrame:
    """Completed count, their total and average score."""
    completed = F.col("status") == "COMPLETED"
    sums = rollup.agg(
        F.count(F.when(completed, 1)).alias("total_completed"),
        F.coalesce(F.sum(F.when(completed, money("score"))), F.lit(0)).alias("_score"),
    )
    return sums.select(
        "total_completed", F.col("_score").cast("double").alias("total_score"),
        F.when(F.col("total_completed") > 0, ratio(F.col("_score"), F.col("total_completed"))).otherwise(0.0).alias("avg_score"),
    )


def weak_topics(rollup: DataFrame) -> DataFrame:
    """Distinct topics, one row each, with the number of keys that name them."""
    topics = rollup.select(F.explode(F.split("weak_topics", ",")).alias("topic")).select(F.trim("topic").alias("topic"))
    return topics.where(F.col("topic") != "").groupBy("topic").agg(F.count("*").alias("key_count"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("layer"), "row_count") for n, df in layers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
