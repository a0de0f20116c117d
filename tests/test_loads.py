"""Restartable loads, versioned tables and streams."""

import pytest
from pyspark.sql import functions as F

from sedimenta import session
from sedimenta.operators.incremental import incremental_load
from sedimenta.operators.ingest import ingest, specs_from_rows
from sedimenta.session import scratch_path
from sedimenta.sources import formats, readers
from sedimenta.sources.config import read_config
from sedimenta.sources.tables import LandingTable, VersionedTable, WatermarkControl
from sedimenta.streaming import sinks

SCHEMA = "order_id bigint, amount double, updated_at timestamp_ntz"


def orders(spark, *rows):
    return spark.createDataFrame(rows, "order_id bigint, amount double, t string").select(
        "order_id", "amount", F.col("t").cast("timestamp_ntz").alias("updated_at")
    )


@pytest.fixture
def load(spark):
    root = scratch_path(spark, "load")
    target, control = LandingTable(spark, f"{root}/t"), WatermarkControl(spark, root)

    def run(source, run_id, **options):
        return incremental_load(
            source, target, control, pipeline_id="p002", run_id=run_id, watermark_column="updated_at",
            reason=F.when(F.col("amount") < 0, "NEGATIVE_AMOUNT"), **options,
        )

    run.target, run.control = target, control
    return run


def test_watermark_follows_valid_rows_only(spark, load):
    source = orders(spark, (1, 5.0, "2024-01-01"), (2, -1.0, "2024-01-03"), (3, 6.0, "2024-01-02"))
    first = load(source, "r1")
    assert (first.extracted, first.loaded, first.rejected) == (3, 2, 1)
    assert first.previous_watermark == "1900-01-01 00:00:00" and first.new_watermark == "2024-01-02 00:00:00"
    second = load(source, "r2")
    # The newer reject is read again; nothing is loaded, so the watermark stays.
    assert (second.extracted, second.loaded, second.rejected) == (1, 0, 1)
    assert second.new_watermark == second.previous_watermark
    assert sorted(r["order_id"] for r in load.target.valid().collect()) == [1, 3]


def test_numeric_run_ids_stay_text(spark, load):
    load(orders(spark, (1, 5.0, "2024-01-01")), "007")
    assert load.target.valid().first()["run_id"] == "007"


def test_watermark_may_pass_rejects(spark, load):
    source = orders(spark, (1, 5.0, "2024-01-01"), (2, -1.0, "2024-01-03"))
    assert load(source, "r1", advance_over_rejects=True).new_watermark == "2024-01-03 00:00:00"
    assert load(source, "r2", advance_over_rejects=True).extracted == 0


def test_a_run_that_failed_before_the_commit_can_be_repeated(spark, load):
    source = orders(spark, (1, 5.0, "2024-01-01"))
    load.target.write_run(source.withColumn("reason_code", F.lit(None).cast("string")), "r1")  # crash before the watermark
    assert load(source, "r1").loaded == 1
    assert load.target.valid().count() == 1


def test_versions_are_pinned_and_replays_change_nothing(spark):
    table = VersionedTable(spark, scratch_path(spark, "v"))
    assert not table.exists()
    assert table.publish(spark.range(3), "a") == 1
    pinned = table.read()
    assert table.publish(spark.range(5), "b") == 2 and table.publish(spark.range(9), "b") == 2
    assert (pinned.count(), table.read().count(), table.read(1).count()) == (3, 5, 3)


def test_pages(spark):
    path = scratch_path(spark, "pages")
    formats.land_pages(spark.range(100).withColumnRenamed("id", "order_id"), "order_id", 50, "/api/v1/payments", path)
    schema = readers.page_schema(spark.range(1).withColumnRenamed("id", "order_id").schema)
    pages = readers.ndjson_table(spark, path, schema)
    assert readers.page_records(pages).count() == 100
    assert tuple(readers.page_completeness(pages).first()) == (2, 2, 100, 1)
    assert tuple(readers.page_completeness(pages.where("page = 1")).first()) == (1, 2, 50, 0)
    assert {r["page"]: r["next_page_url"] for r in pages.collect()} == {1: "/api/v1/payments?page=2", 2: None}


def test_csv_keeps_the_plus_of_a_phone(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([("+919123456001",)], "phone string")
    df.write.option("header", True).csv(path)
    assert readers.csv_table(spark, path, df.schema).first()["phone"] == "+919123456001"


def test_replayed_microbatch_and_compaction(spark, rows):
    schema = "k bigint, v string, seq bigint"
    log = sinks.KeyedLog(spark, scratch_path(spark, "log"), ["k"], ["seq"], spark.createDataFrame([], schema).schema)
    log.append(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema), 0)
    log.append(spark.createDataFrame([(1, "late", 0)], schema), 1)
    log.append(spark.createDataFrame([(1, "late", 0)], schema), 1)  # replay
    expected = [(1, "b", 2), (2, "c", 1)]
    assert log.batches().count() == 3 and rows(log.snapshot()) == expected
    log.compact()
    assert rows(log.snapshot()) == expected
    log.append(spark.createDataFrame([(2, "d", 5)], schema), 2)
    assert rows(log.snapshot()) == [(1, "b", 2), (2, "d", 5)]


def test_stream_continues_from_its_checkpoint(spark):
    path, root = scratch_path(spark, "in"), scratch_path(spark, "out")
    files = sinks.BatchFiles(spark, f"{root}/f")
    run = lambda: sinks.run_available(sinks.ndjson_stream(spark, path, spark.range(1).schema), files.append, f"{root}/c")
    spark.range(5).write.json(path)
    assert sum(run().values()) == 5
    assert sum(run().values()) == 0
    spark.range(5, 12).write.mode("append").json(path)
    assert sum(run().values()) == 7
    assert files.read().count() == 12


def test_interval_trigger(spark):
    path, root = scratch_path(spark, "in"), scratch_path(spark, "out")
    files = sinks.BatchFiles(spark, f"{root}/f")
    spark.range(5).write.json(path)
    query = sinks.run_every(sinks.ndjson_stream(spark, path, spark.range(1).schema), files.append, f"{root}/c", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert files.read().count() == 5


def test_config_files(tmp_path):
    target = tmp_path / "c.json"
    target.write_text('{"sources": [{"id": "p1", "name": "n", "source_type": "csv", "target_table": "t", "ingestion_mode": "full_load", "primary_key": "k"}]}')
    (spec,) = specs_from_rows(read_config(target)["sources"])
    assert spec.is_active == 1 and spec.pii_columns == () and spec.watermark_column is None
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("contracts:\n  orders:\n    required_columns: [order_id]\n")
    assert read_config(tmp_path / "c.yaml") == {"contracts": {"orders": {"required_columns": ["order_id"]}}}


def test_inactive_sources_are_skipped(spark):
    spec = specs_from_rows([{"id": "p1", "name": "n", "source_type": "table", "target_table": "t", "ingestion_mode": "full_load",
                             "primary_key": "id", "is_active": 0}])
    assert ingest(spark, spec, {}, scratch_path(spark, "none"), "r") == []


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        session.scratch_root(Cluster)
