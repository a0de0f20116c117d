"""Repeated runs, repeated keys in a batch and payloads that are no objects."""

from pyspark.sql import functions as F

from sedimenta.operators.incremental import incremental_load
from sedimenta.operators.merge import insert_absent
from sedimenta.operators.quality import schema_drift
from sedimenta.session import scratch_path
from sedimenta.sources.tables import LandingTable, WatermarkControl


def test_a_committed_run_can_be_repeated(spark):
    root = scratch_path(spark, "repeat")
    target, control = LandingTable(spark, f"{root}/t"), WatermarkControl(spark, root)
    source = spark.sql("SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS at FROM range(3)")

    def load():
        return incremental_load(source, target, control, pipeline_id="p", run_id="r1", watermark_column="at", reason=F.lit(None).cast("string"))

    first = load()
    files = sorted(target.valid().inputFiles())
    assert load() == first and first.loaded == 3
    assert sorted(target.valid().inputFiles()) == files and target.valid().count() == 3
    assert control.log().count() == 1


def test_a_run_that_died_before_the_watermark_moved(spark):
    root = scratch_path(spark, "died")
    target, control = LandingTable(spark, f"{root}/t"), WatermarkControl(spark, root)
    control.record({"pipeline_id": "p", "run_id": "r1", "extracted": 2, "loaded": 2, "rejected": 0,
                    "previous_watermark": control.default, "new_watermark": "2024-01-02 00:00:00"})
    source = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 00:00:00' AS at")
    result = incremental_load(source, target, control, pipeline_id="p", run_id="r1", watermark_column="at", reason=F.lit(None).cast("string"))
    assert result.loaded == 2 and control.watermark("p") == "2024-01-02 00:00:00"


def test_a_new_key_that_repeats_is_stored_once(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b"), (3, None)], "k int, v string")
    assert rows(insert_absent(target, batch, ["k"])) == [(1, "a"), (2, "b"), (3, None)]


def test_payloads_that_are_no_objects_drift(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, "{broken"), (3, "[1]"), (4, None)], "id int, p string")
    found = {r.id: r.missing_fields for r in schema_drift(df, "id", "p", {"k": "int"}).collect()}
    assert found == {2: "k", 3: "k", 4: "k"}
