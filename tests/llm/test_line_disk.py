"""What op7 leaves on executors' disks: shuffle files of one step at a time, and nothing broadcast that grows with the texts."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from sedimenta.llm import line_dedup
from sedimenta.session import SHUFFLE_CLEANUP, materialise


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for d in folders for f in Path(str(d)).glob("*/shuffle_*.data")}


def soon(check) -> bool:
    """Files are removed in the background."""
    end = time.time() + 30
    while not check() and time.time() < end:
        time.sleep(0.2)
    return check()


def rows(spark):
    line = "a line that is long enough to take part in what is compared here, said "
    return spark.createDataFrame([(i, f"{line}{i % 7 if i < 20 else i * i * 7919}\nx") for i in range(40)], "doc_id bigint, text string")


def test_a_written_step_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    counted = spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).count()
    table = materialise(counted, "counts")
    assert soon(lambda: shuffle_files(spark) <= before)
    assert table.count() == 1000 and spark.conf.get(SHUFFLE_CLEANUP) == setting
    # The frame that was written can still be read itself, before and after it is written once more.
    assert counted.agg(F.sum("count")).first()[0] == 20_000
    materialise(counted, "counts")
    assert counted.agg(F.sum("count")).first()[0] == 20_000


def test_marks_of_lines_are_not_broadcast(spark):
    kept = line_dedup.dedup_lines(rows(spark), shingle=5)
    assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString()
