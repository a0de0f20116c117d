"""Keys that loads hand out together, and tokens that nothing derives."""

import os

from pyspark.sql import functions as F

from sedimenta.operators import star, vault
from sedimenta.operators.surrogate import KeyRanges, KeyTable
from sedimenta.session import scratch_path


def keys_of(frame):
    return {r.k: r.sk for r in frame.collect()}


def test_colliding_members_get_keys_of_their_own(spark):
    table = KeyTable(spark, scratch_path(spark, "keys"), ["k"], "sk", length=1)
    members = spark.range(40).select(F.col("id").alias("k"))
    first = keys_of(table.assign(members.where("k < 9"), "r1"))
    assert len(set(first.values())) == 9 and all(0 <= v for v in first.values())
    every = keys_of(table.assign(members, "r2"))
    assert len(set(every.values())) == 40 and {k: every[k] for k in first} == first
    assert keys_of(table.assign(members.where("k in (3, 30)"), "r3")) == {k: every[k] for k in (3, 30)}
    assert table.table.log.last_number() == 2  # nothing new was stored by the third


def test_no_fact_is_doubled_by_a_collision(spark, sf):
    from sedimenta.plans.dimension import checked_customers
    from sedimenta.sources import entities

    dim = checked_customers(spark, sf, length=2)  # 256 hashes for more members
    assert dim.groupBy("customer_sk").count().where("count > 1").count() == 0
    items, orders = entities.order_items(spark, sf), entities.source_orders(spark, sf)
    facts = star.load_facts(items, orders, customers=dim)
    assert facts.count() == items.count()
    back = facts.join(dim.select("customer_sk", "customer_id"), "customer_sk").groupBy("customer_id").count()
    known = orders.join(dim.select("customer_id"), "customer_id", "left_semi").join(items, "order_id").groupBy("customer_id").count()
    assert back.where("customer_id <> -1").exceptAll(known).count() == 0


def test_two_loads_at_once_share_no_key(spark):
    root = scratch_path(spark, "keys")
    mine, other = (KeyTable(spark, root, ["k"], "sk", length=1) for _ in range(2))
    members = spark.range(12).select(F.col("id").alias("k"))
    real = mine.table.log.put

    def put(number, record):
        mine.table.log.put = real
        other.assign(members.where("k % 2 = 0"), "other")
        return real(number, record)

    mine.table.log.put = put
    got = keys_of(mine.assign(members, "mine"))
    assert len(got) == 12 and len(set(got.values())) == 12
    assert keys_of(other.read()) == got


def test_interleaved_ranges_are_disjoint(spark):
    root = scratch_path(spark, "ranges")
    mine, other = KeyRanges(spark, root), KeyRanges(spark, root)
    real = mine.log.put

    def put(number, record):
        mine.log.put = real
        assert other.reserve(5, "other") == 1
        return real(number, record)

    mine.log.put = put
    assert mine.reserve(3, "mine") == 6
    assert mine.reserve(3, "mine") == 6 and other.reserve(0, "none") == 9 and other.reserve(2, "next") == 9
    rows = spark.range(10, 14).select(F.col("id").alias("k"))
    numbered = mine.number(rows, ["k"], "sk", "rows")
    assert sorted((r.k, r.sk) for r in numbered.collect()) == [(10, 11), (11, 12), (12, 13), (13, 14)]


def vault_of(spark, root):
    row = spark.createDataFrame([], "k bigint, email string").schema
    return vault.TokenVault(spark, root, "k", row, most_rows=10)


def test_tokens_are_kept_and_erasure_leaves_no_trace(spark):
    root = scratch_path(spark, "vault")
    persons = spark.range(60).select(F.col("id").alias("k"), F.concat(F.lit("secret-"), "id", F.lit("@x")).alias("email"))
    stored = vault_of(spark, root)
    stored.assign(persons.where("k < 40"), "r1")
    before = {r.k: r.k_token for r in stored.read().collect()}
    assert len(set(before.values())) == 40 and all(len(t) == 32 for t in before.values())
    stored.assign(persons, "r2")
    stored.assign(persons.unionByName(persons), "r3")
    tokens = {r.k: r.k_token for r in stored.read().collect()}
    assert len(tokens) == 60 and {k: tokens[k] for k in before} == before
    facts = spark.createDataFrame([(1, "a@x", 5), (2, "b@x", 7), (1, "a@x", 9)], "k bigint, email string, spend int")
    assert sorted((r.k_token, r.spend) for r in stored.tokenise(facts).collect()) == sorted(
        [(tokens[1], 5), (tokens[1], 9), (tokens[2], 7)])

    stored.erase(spark.createDataFrame([(1,), (77,)], "k bigint"), "forget")
    left = {r.k: r.k_token for r in vault_of(spark, root).read().collect()}
    assert left == {k: t for k, t in tokens.items() if k != 1}
    folder = root.replace("file:", "", 1)
    files = [f"{d}/{n}" for d, _, names in os.walk(folder) for n in names]
    held = spark.read.schema("k bigint, email string, k_token string").parquet(
        *sorted({os.path.dirname(f) for f in files if f.endswith(".parquet")}))
    assert held.where("k = 1").count() == 0 and held.count() == 59
    # The same person, stored again, is somebody new.
    stored.assign(persons.where("k = 1"), "r4")
    assert {r.k: r.k_token for r in stored.read().collect()}[1] != tokens[1]
