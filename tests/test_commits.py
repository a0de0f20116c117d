"""Writers that interleave: commits, versions, partitions and runs of loads."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import layout
from sedimenta.operators.incremental import incremental_load
from sedimenta.session import scratch_path
from sedimenta.sources.commits import CommitLog, ConcurrentCommit
from sedimenta.sources.tables import LandingTable, PartitionedTable, VersionedTable, WatermarkControl


def before_put(log, act):
    """Let ``act`` happen right before the next commit of ``log`` is tried."""
    real = log.put

    def put(number, record):
        log.put = real
        act()
        return real(number, record)

    log.put = put


def test_one_of_many_writers_creates_a_commit(spark):
    path = scratch_path(spark, "commits")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: CommitLog(spark, path).put(1, {"writer": i}), range(16)))
    assert sum(won) == 1
    log = CommitLog(spark, path)
    assert log.last() == (1, {"writer": won.index(True), "number": 1})
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: CommitLog(spark, path).append(lambda n: {"writer": i, "n": n}), range(12)))
    assert sorted(numbers) == list(range(2, 14))
    assert all(log.get(n)["n"] == n for n in numbers)
    assert [r.number for r in log.frame("number bigint").orderBy("number").collect()] == list(range(1, 14))


def test_a_commit_on_a_file_system_without_links(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.other.link./in", f"file://{tmp_path}")
    log = CommitLog(spark, "viewfs://other/in/log")
    assert log.put(1, {"a": 1}) and not log.put(1, {"a": 2}) and log.get(1)["a"] == 1


def test_two_publishers_keep_both_versions(spark):
    root = scratch_path(spark, "both")
    mine, other = VersionedTable(spark, root), VersionedTable(spark, root)
    before_put(mine.log, lambda: other.publish(spark.range(5), "other"))
    assert mine.publish(spark.range(3), "mine") == 2
    assert [mine.read(v).count() for v in (1, 2)] == [5, 3]
    assert {r.run_id: r.version for r in mine.history().collect()} == {"other": 1, "mine": 2}


def test_a_writer_that_read_an_older_version_is_refused(spark):
    root = scratch_path(spark, "read")
    mine, other = VersionedTable(spark, root), VersionedTable(spark, root)
    mine.publish(spark.range(3), "first")
    before_put(mine.log, lambda: other.publish(spark.range(10), "other"))
    with pytest.raises(ConcurrentCommit):
        mine.publish(mine.read().where("id > 0"), "mine", expected=1)
    assert mine.current()["run_id"] == "other"


def test_an_update_is_computed_again(spark):
    root = scratch_path(spark, "update")
    mine, other = VersionedTable(spark, root), VersionedTable(spark, root)
    mine.publish(spark.range(3), "first")
    before_put(mine.log, lambda: other.update(lambda df: df.unionByName(spark.range(3, 5)), "other"))
    assert mine.update(lambda df: df.unionByName(spark.range(100, 101)), "mine") == 3
    assert sorted(r.id for r in mine.read().collect()) == [0, 1, 2, 3, 4, 100]
    assert mine.update(lambda df: df.limit(0), "mine") == 3  # a committed run is not done again
    assert mine.update(lambda df: df.limit(0), "none") == 4 and mine.read().count() == 0


def test_one_run_published_twice_at_once_is_one_version(spark):
    root = scratch_path(spark, "same")
    mine, other = VersionedTable(spark, root), VersionedTable(spark, root)
    mine.publish(spark.range(1), "first")
    before_put(mine.log, lambda: other.publish(spark.range(2), "run"))
    assert mine.publish(spark.range(2), "run") == 2 and mine.log.last_number() == 2


def parts(spark, rows):
    return spark.createDataFrame(rows, "k bigint, p string, v int")


def table_of(spark, rows):
    table = PartitionedTable(spark, scratch_path(spark, "parts"), "p")
    table.replace(parts(spark, rows), "first")
    return table


def test_a_reader_keeps_its_version(spark, rows):
    table = table_of(spark, [(1, "a", 1), (2, "a/b =%", 2), (3, None, 3), (4, "", 4)])
    reader, files = table.read(), set(table.read().inputFiles())
    layout.refresh_groups(table, parts(spark, [(9, "a/b =%", 9)]), "refresh")
    assert rows(reader) == sorted([(1, "a", 1), (2, "a/b =%", 2), (3, None, 3), (4, "", 4)], key=repr)
    assert rows(table.read()) == sorted([(1, "a", 1), (9, "a/b =%", 9), (3, None, 3), (4, "", 4)], key=repr)
    assert len(set(table.read().inputFiles()) & files) == 3  # untouched partitions keep their files
    assert rows(table.read(only=[None, "none"])) == [(3, None, 3)] and rows(table.read(only=[""])) == [(4, "", 4)]
    assert rows(table.read(version=1)) == rows(reader)


def test_a_touched_partition_without_rows_is_dropped(spark, rows):
    table = table_of(spark, [(1, "a", 1), (2, "b", 2)])
    table.replace(parts(spark, []), "gone", touched=["b"])
    assert rows(table.read()) == [(1, "a", 1)] and set(table.entries(1)) == {"a", "b"}
    with pytest.raises(ValueError):
        table.replace(parts(spark, [(1, "c", 1)]), "stray", touched=["b"])


def test_writers_of_different_partitions_do_not_disturb_each_other(spark, rows):
    table = table_of(spark, [(1, "a", 1), (2, "b", 2)])
    other = PartitionedTable(spark, table.root, "p")
    before_put(table.log, lambda: other.replace(parts(spark, [(2, "b", 20)]), "other", based_on=1))
    assert table.replace(parts(spark, [(1, "a", 10)]), "mine", based_on=1) == 3
    assert rows(table.read()) == [(1, "a", 10), (2, "b", 20)]
    before_put(table.log, lambda: other.replace(parts(spark, [(1, "a", 11)]), "again", based_on=3))
    with pytest.raises(ConcurrentCommit):
        table.replace(parts(spark, [(1, "a", 12)]), "late", based_on=3)
    assert rows(table.read()) == [(1, "a", 11), (2, "b", 20)]


def test_a_map_that_is_repeated_loses_no_partition(spark, rows, monkeypatch):
    monkeypatch.setattr(PartitionedTable, "FULL_EVERY", 3)
    table = table_of(spark, [(1, "a", 0), (2, "b", 0)])
    for i in range(1, 8):
        touched = "a" if i % 2 else f"n{i}"
        table.replace(parts(spark, [(1, touched, i)]), f"run{i}")
        table.replace(parts(spark, [(1, touched, 99)]), f"run{i}")  # repeated: nothing changes
    assert table.version() == 8
    assert rows(table.read()) == sorted([(1, "a", 7), (2, "b", 0), (1, "n2", 2), (1, "n4", 4), (1, "n6", 6)], key=repr)
    assert rows(table.read(4)) == sorted([(1, "a", 3), (2, "b", 0), (1, "n2", 2)], key=repr)


def test_upsert_reads_only_touched_partitions(spark, rows):
    table = table_of(spark, [(i, "abc"[i % 3], 0) for i in range(9)])
    files = {v: e["path"] for v, e in table.entries().items()}
    batch = parts(spark, [(0, "a", 5), (0, "a", 6), (100, "d", 7)])
    found = layout.upsert_partitions(table, batch, ["k"], ["v"], ["v"], "up")
    assert rows(found.where("v > 0")) == [(0, "a", 6), (100, "d", 7)] and found.count() == 10
    now = {v: e["path"] for v, e in table.entries().items()}
    assert now["b"] == files["b"] and now["c"] == files["c"] and now["a"] != files["a"]


def test_a_key_that_moved_is_refused(spark):
    table = table_of(spark, [(1, "a", 1), (2, "b", 2)])
    with pytest.raises(layout.MovedKeys):
        layout.upsert_partitions(table, parts(spark, [(1, "b", 5)]), ["k"], ["v"], ["v"], "moved")
    assert table.version() == 1


SOURCE = "SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS at FROM range({0})"


def loading(spark, root, run_id, n=3, control=None):
    target = LandingTable(spark, f"{root}/t")
    result = incremental_load(
        spark.sql(SOURCE.format(n)), target, control or WatermarkControl(spark, root), pipeline_id="p/1", run_id=run_id,
        watermark_column="at", reason=F.lit(None).cast("string"))
    return target, result


def test_a_run_without_rows_can_be_read(spark):
    root = scratch_path(spark, "empty")
    target, result = loading(spark, root, "r1", n=0)
    assert result.extracted == 0 and target.valid().collect() == [] and target.rejected().columns == ["id", "at", "reason_code", "run_id"]


def test_two_runs_do_not_load_one_interval(spark):
    root = scratch_path(spark, "interval")
    control = WatermarkControl(spark, root)
    real = control.record

    def overtaken(result, after=None):
        control.record = real
        loading(spark, root, "other")
        return real(result, after)

    control.record = overtaken
    with pytest.raises(ConcurrentCommit):
        loading(spark, root, "mine", control=control)
    target = LandingTable(spark, f"{root}/t")
    assert {r.run_id for r in target.valid().collect()} == {"other"} and target.valid().count() == 3
    assert loading(spark, root, "mine")[1].extracted == 0  # repeated after the other run


def test_rows_of_a_run_that_died_become_visible_when_it_is_repeated(spark, monkeypatch):
    root = scratch_path(spark, "dies")
    with monkeypatch.context() as m:
        m.setattr(LandingTable, "commit", lambda self, staged: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loading(spark, root, "r1")
    target, result = loading(spark, root, "r1")
    assert result.loaded == 3 and target.valid().count() == 3
    assert WatermarkControl(spark, root).log().count() == 1
