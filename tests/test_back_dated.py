"""Versions that become known late, against a model that goes through the days."""

import datetime
import random

from pyspark.sql import functions as F

from sedimenta.operators import scd, star

DAY = datetime.date(2024, 1, 1)
DIM = "sk bigint, k bigint, city string, tag string, effective_date date, expiry_date date, is_current int, version bigint"


def day(n):
    return None if n is None else DAY + datetime.timedelta(days=n)


def histories(rng, keys):
    """Histories with gaps and closed ends: (sk, key, city, start, end)."""
    out = []
    for k in range(keys):
        start = rng.randrange(10)
        for _ in range(rng.randrange(1, 5)):
            end = start + rng.randrange(1, 20)
            out.append([1000 * k + start, k, f"c{start}", start, end])
            start = end + (rng.randrange(1, 6) if rng.random() < 0.2 else 0)
        if rng.random() < 0.7:
            out[-1][4] = None
    return out


def frames(spark, stored):
    rows, version = [], {}
    for sk, k, city, start, end in stored:
        version[k] = version.get(k, 0) + 1
        rows.append((sk, k, city, f"t{sk}", day(start), day(end), int(end is None), version[k]))
    return spark.createDataFrame(rows, DIM)


def slow(stored, late):
    """Intervals after the late rows: (key, start, end, city, sk)."""
    out = []
    for k in {r[1] for r in stored} | {r[0] for r in late}:
        rows = {start: [start, end, city, sk, False] for sk, key, city, start, end in stored if key == k}
        for key, start, city, sk in sorted(late, key=lambda r: r[2]):
            if key != k:
                continue
            if start in rows:
                rows[start][2] = city
            else:
                rows[start] = [start, None, city, sk, True]
        covering = None
        ordered = [rows[s] for s in sorted(rows)]
        for i, row in enumerate(ordered):
            nxt = ordered[i + 1][0] if i + 1 < len(ordered) else None
            if row[4]:
                row[1] = covering if covering is not None and covering > row[0] else None
            else:
                covering = row[1]
            if nxt is not None and (row[1] is None or nxt < row[1]):
                row[1] = nxt
        out += [(k, r[0], r[1], r[2], r[3], v + 1) for v, r in enumerate(ordered)]
    return sorted(out, key=repr)


def test_inserted_versions_and_repointed_facts(spark, rows):
    rng = random.Random(11)
    stored = histories(rng, 40)
    late = []
    for _ in range(60):
        k, start = rng.randrange(45), rng.randrange(80)
        if not any(r[0] == k and r[1] == start for r in late):
            late.append((k, start, f"late{len(late)}", 1_000_000 + len(late)))
    same_day = next(r for r in stored if r[1] == 3)
    late = [r for r in late if (r[0], r[1]) != (3, same_day[3])] + [(3, same_day[3], "a", 5), (3, same_day[3], "b", 5)]  # a repeat: b is last
    before = frames(spark, stored)
    rows_of_late = [(k, day(s), c, sk, None) for k, s, c, sk in late]
    after = scd.insert_versions(
        before, spark.createDataFrame(rows_of_late, "k bigint, effective_date date, city string, sk bigint, tag string"),
        "k", ["city"], "sk", ["city"], buckets=7)
    got = sorted(((r.k, (r.effective_date - DAY).days, r.expiry_date and (r.expiry_date - DAY).days, r.city, r.sk, r.version)
                  for r in after.collect()), key=repr)
    want = slow(stored, late)
    assert got == want
    assert {r.is_current for r in after.where("expiry_date is null").collect()} == {1}
    untouched = {r[1] for r in stored} - {r[0] for r in late}
    assert rows(after.where(F.col("k").isin(*untouched))) == rows(before.where(F.col("k").isin(*untouched)))
    assert after.where("tag is null").count() == len({(k, s) for k, s, *_ in late} - {(r[1], r[3]) for r in stored})

    def covering(intervals, k, d):
        return next((i for i in intervals if i[0] == k and i[1] <= d and (i[2] is None or d < i[2])), None)

    intervals = [(r[1], r[3], r[4], r[2], r[0]) for r in stored]
    facts, expected = [], []
    for n in range(600):
        k, d = rng.randrange(40), rng.randrange(90)
        was = covering(intervals, k, d)
        if was is None:
            facts.append((n, day(d), -1))
            expected.append((n, day(d), -1))
            continue
        now = covering(want, k, d)
        facts.append((n, day(d), was[4]))
        expected.append((n, day(d), now[4]))
    found = star.repoint_back_dated(
        spark.createDataFrame(facts, "n bigint, at date, sk bigint"), before, after, "k", "sk", "at", ["n"])
    assert rows(found) == sorted(expected, key=repr)
    assert expected != facts


def test_a_whole_history_stays_whole(spark):
    rng = random.Random(3)
    stored = []
    for k in range(20):
        starts = sorted(rng.sample(range(100), 4))
        stored += [[1000 * k + s, k, f"c{s}", s, e] for s, e in zip(starts, [*starts[1:], None])]
    late = [(k, day(rng.randrange(100)), "late", 10**6 + k, None) for k in range(20)]
    after = scd.insert_versions(
        frames(spark, stored), spark.createDataFrame(late, "k bigint, effective_date date, city string, sk bigint, tag string"),
        "k", ["city"], "sk", ["city"])
    assert {r.violation_count for r in scd.validate_history(after, "k").collect()} == {0}


def test_no_late_rows(spark, rows):
    before = frames(spark, histories(random.Random(1), 5))
    none = spark.createDataFrame([], "k bigint, effective_date date, city string, sk bigint")
    assert rows(scd.insert_versions(before, none, "k", ["city"], "sk", ["city"])) == rows(before)
