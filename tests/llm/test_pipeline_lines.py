"""The pipeline on planted edits of lines of normal length, against all pairs."""

import __spark_entry__
import corpus_pipeline
from sedimenta.session import scratch_path
from tests.llm.test_line_edits import left, planted

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in planted()], SCHEMA)


def test_the_lines_stage_finds_what_op7_finds(spark):
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["lines"](spark, docs(spark), "").collect()}
    assert got == left(planted(), 5)
    # By default the stage does the same.
    assert got == {r.doc_id for r in corpus_pipeline.lines(spark, docs(spark), "").collect()}
    assert got < left(planted(), 12)


def test_the_registered_pipeline_leaves_no_near_copy_of_a_line(spark):
    path = scratch_path(spark, "edits")
    docs(spark).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id for r in __spark_entry__.queries()["pipeline"](spark, path).collect()}
    assert got == left(planted(), 5)
