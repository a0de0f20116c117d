"""Footer statistics against the rows of the files."""

import datetime
import decimal
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sedimenta.operators import footers


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(4)
    path = tmp_path_factory.mktemp("footers")
    for f in range(3):
        n = 40 + f
        pq.write_table(pa.table({
            "i": pa.array([rng.choice([None, rng.randrange(-50, 50)]) for _ in range(n)], pa.int64()),
            "x": pa.array([rng.uniform(-1, 1) for _ in range(n)]),
            "big": pa.array([2**62 + rng.randrange(1000) for _ in range(n)], pa.int64()),
            "d": pa.array([datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randrange(30)) for _ in range(n)]),
            "t": pa.array([datetime.datetime(1960, 1, 1) + datetime.timedelta(seconds=rng.randrange(10**9)) for _ in range(n)], pa.timestamp("us")),
            "m": pa.array([decimal.Decimal(rng.randrange(10**6)) / 100 for _ in range(n)], pa.decimal128(12, 2)),
            "s": pa.array([rng.choice("abc") * rng.randrange(1, 4) for _ in range(n)]),
            "none": pa.array([None] * n, pa.int32()),
            "nested": pa.array([{"a": 1}] * n),
        }), path / f"part-{f}.parquet", row_group_size=9)
    return path


def groups(folder):
    for file in sorted(folder.glob("*.parquet")):
        parquet = pq.ParquetFile(file)
        for g in range(parquet.num_row_groups):
            yield file.name, g, parquet.read_row_group(g).to_pydict()


def test_bounds_hold_the_rows(spark, folder):
    stats = {(r.file.rsplit("/", 1)[1], r.row_group, r.column_name): r for r in footers.statistics(spark, str(folder)).collect()}
    epoch = datetime.datetime(1970, 1, 1)
    for name, g, rows in groups(folder):
        for column in ("i", "x", "big", "d", "t", "m"):
            values = [v for v in rows[column] if v is not None]
            if column == "d":
                values = [(v - epoch.date()).days for v in values]
            if column == "t":
                values = [(v - epoch) // datetime.timedelta(microseconds=1) for v in values]
            s = stats[name, g, column]
            assert s.low <= min(values) and s.high >= max(values) and s.nulls == rows[column].count(None)
            if column not in ("big", "m"):  # a double does not hold all of these
                assert (s.low, s.high) == (float(min(values)), float(max(values)))
        s = stats[name, g, "s"]
        assert (s.low_text, s.high_text, s.low) == (min(rows["s"]), max(rows["s"]), None)
        assert stats[name, g, "none"].low is None and stats[name, g, "none"].nulls == stats[name, g, "none"].rows
        assert (name, g, "nested.a") not in stats


@pytest.mark.parametrize("ranges", [
    {}, {"i": (10, None)}, {"i": (None, -20)}, {"i": (45, 46), "x": (0.9, None)}, {"none": (0, 1)}, {"s": (0, 1)}, {"i": (500, None)}])
def test_no_wanted_row_is_skipped(spark, folder, ranges):
    read = {(r.file.rsplit("/", 1)[1], r.row_group): r.is_read for r in footers.groups_in(footers.statistics(spark, str(folder)), ranges).collect()}
    assert len(read) == 15
    for name, g, rows in groups(folder):
        possible = all(
            c in ("none", "s") or any(v is not None and (low is None or v >= low) and (high is None or v <= high) for v in rows[c])
            for c, (low, high) in ranges.items())
        if possible:
            assert read[name, g]
        for c, (low, high) in ranges.items():
            values = [v for v in rows[c] if v is not None] if c not in ("none", "s") else []
            if values and (low is not None and max(values) < low or high is not None and min(values) > high):
                assert not read[name, g]


def test_skipping_counts(spark, folder):
    stats = footers.statistics(spark, str(folder))
    row = footers.skipping(stats, {"i": (500, None)}, "all").first()
    assert tuple(row) == ("all", 15, 0, 123, 0)
    assert tuple(footers.skipping(stats, {}, "none").first()) == ("none", 15, 15, 123, 123)
