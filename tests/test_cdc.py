"""Change application against a slow event-by-event fold."""

import random

import pytest

from sedimenta.operators import cdc

COLUMNS = "k bigint, name string, email string, updated bigint"


def fold(target, events):
    state = {r[0]: list(r[1:]) for r in target}
    for k, op, name, email, updated, _seq in sorted(events, key=lambda e: e[5]):
        if op == "I":
            state[k] = [name, email, updated]
        elif op == "D":
            state.pop(k, None)
        elif k in state:
            if email is not None:
                state[k][1] = email
            state[k][2] = updated
    return sorted((k, *v) for k, v in state.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_flat_changes_equal_the_fold(spark, rows, seed):
    rng = random.Random(seed)
    target = [(k, f"n{k}", rng.choice([None, f"t{k}"]), 0) for k in range(0, 40, 2)]
    events = [
        (3 if rng.random() < 0.34 else rng.randrange(40), rng.choice("IUUD"), f"n{i}", rng.choice([None, f"e{i}"]), i, i)
        for i in range(1, 600)
    ]
    changes = spark.createDataFrame(events, "k bigint, op string, name string, email string, updated bigint, seq bigint")
    out = cdc.apply_flat_changes(spark.createDataFrame(target, COLUMNS), changes, "k", ["email", "updated"], ["seq"])
    assert rows(out) == sorted(fold(target, events), key=repr)


def test_insert_update_delete_leaves_nothing(spark):
    target = spark.createDataFrame([], COLUMNS)
    events = [
        (501, "I", "Rohan", "rohan@example.com", 1, 1),
        (501, "U", "Rohan", "rohan.sharma@example.com", 2, 2),
        (501, "D", None, None, 3, 3),
    ]
    schema = "k bigint, op string, name string, email string, updated bigint, seq bigint"
    apply = lambda n: cdc.apply_flat_changes(target, spark.createDataFrame(events[:n], schema), "k", ["email", "updated"], ["seq"])
    assert [tuple(r) for r in apply(2).collect()] == [(501, "Rohan", "rohan.sharma@example.com", 2)]
    assert apply(3).count() == 0


def test_envelopes_are_idempotent(spark, rows):
    image = "struct<order_id:bigint,status:string,amount:double>"
    envelopes = spark.createDataFrame([
        ("u", 2, {"order_id": 501, "status": "PENDING", "amount": 1200.0}, {"order_id": 501, "status": "DELIVERED", "amount": 1200.0}, 1),
        ("c", 1, None, {"order_id": 502, "status": "PENDING", "amount": 5.0}, 2),
        ("d", 3, {"order_id": 503, "status": "PENDING", "amount": 9.0}, None, 3),
    ], f"op string, ts_ms bigint, before {image}, after {image}, seq bigint")
    target = spark.createDataFrame([(501, "PENDING", 1200.0), (503, "PENDING", 9.0), (504, "NEW", 1.0)], "order_id bigint, status string, amount double")
    once = cdc.apply_envelopes(target, envelopes, "order_id", ["seq"])
    assert rows(once) == [(501, "DELIVERED", 1200.0), (502, "PENDING", 5.0), (504, "NEW", 1.0)]
    assert rows(cdc.apply_envelopes(once, envelopes, "order_id", ["seq"])) == rows(once)
