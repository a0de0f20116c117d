"""Star schema: dimensions with an unknown member, fact load, late dimensions, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import date_key
from sedimenta.functions.keys import UNKNOWN_KEY, or_unknown
from sedimenta.functions.money import sum_exact
from sedimenta.operators.merge import insert_absent
from sedimenta.operators.scd import as_of_lookup
from sedimenta.session import materialise

# The unknown member of each dimension.
UNKNOWN_CUSTOMER = {
    "customer_sk": -1, "customer_id": -1, "first_name": "Unknown", "last_name": "Customer",
    "email": "unknown@domain.com", "city": "Unknown", "state": "Unknown",
    "effective_date": "1900-01-01", "expiry_date": None, "is_current": 1, "version": 1,
}
UNKNOWN_PRODUCT = {
    "product_sk": -1, "product_id": -1, "product_name": "Unknown Product", "category": "Unknown",
    "current_price": 0.0, "previous_category": None, "effective_date": "1900-01-01", "is_current": 1,
}
UNKNOWN_STORE = {
    "store_sk": -1, "store_id": -1, "store_name": "Unknown Store", "city": "Unknown", "state": "Unknown",
}
UNKNOWN_PRESCRIPTION = {
    "prescription_sk": -1, "prescription_id": -1, "customer_id": -1, "sphere_left": 0.0, "sphere_right": 0.0,
    "lens_type": "Unknown", "created_at": "1900-01-01 00:00:00",
}


def unknown_member(dim: DataFrame, member: dict) -> DataFrame:
    """The -1 row in the shape of ``dim``; columns the member does not name become NULL."""
    return dim.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema]
    )


def seeded(members: DataFrame, member: dict) -> DataFrame:
    """Freshly built members, none of which can have the key -1, with the unknown member."""
    return members.unionByName(unknown_member(members, member))


def ensure_unknown_member(dim: DataFrame, member: dict, key: str) -> DataFrame:
    """A stored dimension with the unknown member added unless it is there."""
    return insert_absent(dim, unknown_member(dim, member), [key])


def new_members(source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Source rows whose business key the dimension does not hold yet."""
    return source.join(dim, key, "left_anti")


def load_facts(
    items: DataFrame, orders: DataFrame, *, customers: DataFrame | None = None, products: DataFrame | None = None,
    stores: DataFrame | None = None, loaded: DataFrame | None = None,
) -> DataFrame:
    """Order lines with dimension keys; an unmatched dimension gives the unknown member.

    Only the dimensions passed are looked up, as Spark cannot drop a left join it does not need.
    With ``loaded``, only orders without any loaded line are taken, so late lines of a loaded order
    are skipped. Orders get their customer and store keys before they meet the lines: the wide side
    is shuffled once by order and once by product, never by a key that a hot customer dominates.
    """
    if loaded is not None:
        orders = orders.join(loaded.select("order_id").distinct(), "order_id", "left_anti")
    keyed, keys = _keyed_orders(orders, customers, stores)
    lines = items.join(keyed, "order_id")
    if products is not None:
        current = products.where(F.col("is_current") == 1).select("product_id", "product_sk")
        lines = lines.join(current, "product_id", "left")
        keys = [*keys, or_unknown("product_sk").alias("product_sk")]
    return lines.select(
        "order_id", *keys, "date_key", "quantity", "unit_price", "total_price", "discount_amount",
        (F.col("total_price") - F.col("discount_amount")).alias("net_amount"),
    )


def load_order_facts(
    items: DataFrame, orders: DataFrame, *, customers: DataFrame | None = None, stores: DataFrame | None = None
) -> DataFrame:
    """Facts at order grain: lines are summed per order before they meet the order.

    The sums leave the lines partitioned by order, which is what the join needs, so aggregating
    first costs no shuffle and everything behind it handles one row per order.
    """
    keyed, keys = _keyed_orders(orders, customers, stores)
    sums = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        *[F.sum(m).alias(m) for m in ("quantity", "total_price", "discount_amount")],
    )
    return sums.join(keyed, "order_id").select(
        "order_id", *keys, "date_key", "line_count", "quantity", "total_price", "discount_amount",
        (F.col("total_price") - F.col("discount_amount")).alias("net_amount"),
    )


def to_order_grain(facts: DataFrame) -> DataFrame:
    """A stored line fact table reduced to order grain."""
    measures = ["quantity", "total_price", "discount_amount", "net_amount"]
    keys = [c for c in ("order_id", "customer_sk", "store_sk", "date_key") if c in facts.columns]
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("line_count"), *[F.sum(m).alias(m) for m in measures])


def _keyed_orders(orders: DataFrame, customers: DataFrame | None, stores: DataFrame | None) -> tuple[DataFrame, list]:
    """Orders with their date key and the keys of the given dimensions, and the names of those keys."""
    keys = []
    if customers is not None:
        current = customers.where(F.col("is_current") == 1).select("customer_id", "customer_sk")
        orders = orders.join(current, "customer_id", "left")
        keys.append("customer_sk")
    if stores is not None:
        orders = orders.join(stores.select("store_id", "store_sk"), "store_id", "left")
        keys.append("store_sk")
    keyed = orders.select("order_id", *[or_unknown(k).alias(k) for k in keys], date_key("created_at").alias("date_key"))
    return keyed, keys


def repoint_late(facts: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Give facts at the unknown customer their real key once the dimension row has arrived.

    Only those facts are joined again; all others pass through untouched.
    """
    known = facts.where(F.col("customer_sk") != UNKNOWN_KEY)
    late = facts.where(F.col("customer_sk") == UNKNOWN_KEY)
    arrived = customers.where(F.col("is_current") == 1).select("customer_id", F.col("customer_sk").alias("_late_sk"))
    found = (
        orders.select("order_id", "customer_id")
        .join(late.select("order_id").distinct(), "order_id", "left_semi")
        .join(arrived, "customer_id")
    )
    repointed = late.join(found, "order_id", "left").withColumn("customer_sk", F.coalesce("_late_sk", "customer_sk"))
    return known.unionByName(repointed.select(*facts.columns))


def repoint_back_dated(
    facts: DataFrame, before: DataFrame, after: DataFrame, key: str, surrogate: str, fact_date: str, tiebreak: list[str]
) -> DataFrame:
    """Facts that point at a version which ends earlier ``after`` than ``before`` get the version that now covers their date.

    Only facts of shortened versions, from the new end on, are looked up again; all others keep their key. ``facts`` should be a
    table; it is read twice. A date that no version covers gets the unknown member; facts that are there already are left to
    ``repoint_late``.
    """
    old, new = F.col("_old"), F.col("expiry_date")
    shortened = after.select(key, surrogate, "expiry_date").join(before.select(surrogate, F.col("expiry_date").alias("_old")), surrogate)
    shortened = shortened.where(new.isNotNull() & (old.isNull() | (new < old))).select(surrogate, F.col(key).alias("_key"), new.alias("_until"))
    pointed = facts.join(shortened, surrogate, "left")
    moves = F.coalesce(F.col(fact_date).cast("date") >= F.col("_until"), F.lit(False))
    inside = materialise(pointed.where(moves).drop(surrogate, "_until"), "inside")
    versions = after.join(shortened.select(F.col("_key").alias(key)).distinct(), key, "left_semi").withColumnRenamed(key, "_key")
    found = as_of_lookup(inside, versions, "_key", fact_date, [surrogate], tiebreak).withColumn(surrogate, or_unknown(surrogate))
    return pointed.where(~moves).select(*facts.columns).unionByName(found.select(*facts.columns))


def daily_snapshot(order_facts: DataFrame) -> DataFrame:
    """Periodic snapshot: one row per store and day with sales."""
    return order_facts.groupBy("date_key", "store_sk").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
        sum_exact("total_price").alias("total_gross_revenue"),
        sum_exact("net_amount").alias("total_net_revenue"),
    )


def store_days(stores: DataFrame, days: DataFrame) -> DataFrame:
    """Every store on every day of a one-row ``first_day``/``last_day`` frame.

    Each store row generates its own days, so nothing is paired by a join.
    """
    first, last = days.select("first_day").scalar(), days.select("last_day").scalar()
    return stores.withColumn("full_date", F.explode(F.sequence(first, last)))


def dense_snapshot(snapshot: DataFrame, spine: DataFrame) -> DataFrame:
    """Periodic snapshot with a zero row for each store-day without sales."""
    keyed = spine.select(date_key("full_date").alias("date_key"), "store_sk")
    measures = [c for c in snapshot.columns if c not in ("date_key", "store_sk")]
    zero = {c: F.lit(0).cast(snapshot.schema[c].dataType) for c in measures}
    return keyed.join(snapshot, ["date_key", "store_sk"], "left").select(
        "date_key", "store_sk", *[F.coalesce(F.col(c), zero[c]).alias(c) for c in measures]
    )


def lifecycle(orders: DataFrame, milestones: DataFrame, limit_minutes: int) -> DataFrame:
    """Accumulating snapshot: one row per order with the first time of each milestone."""
    def first(status: str):
        return F.min(F.when(F.col("status") == status, F.col("ts")))

    reached = milestones.groupBy("order_id").agg(
        first("ASSIGNED").alias("order_assigned_ts"),
        first("PICKED").alias("order_picked_ts"),
        first("DELIVERED").alias("order_delivered_ts"),
        F.max("partner_id").alias("delivery_partner_id"),
    )
    minutes = F.timestamp_diff("MINUTE", F.col("order_placed_ts"), F.col("order_delivered_ts"))
    return (
        orders.select("order_id", F.col("created_at").alias("order_placed_ts"))
        .join(reached, "order_id", "left")
        .withColumn("delivery_duration_minutes", minutes.cast("double"))
        .withColumn("is_on_time", F.when(F.col("delivery_duration_minutes") > limit_minutes, 0).otherwise(1))
    )
