"""Readers for the supported source styles. Every reader takes an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Declared schemas of the given tables; declaring them spares a footer-reading job per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row. Inference would turn ``+91...`` phones into numbers."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def ndjson_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; splittable."""
    return spark.read.schema(schema).json(path)


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each; a file is read whole by one task, so land it once."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def jdbc_table(
    spark: SparkSession, url: str, name: str, key: str, lower: int, upper: int, partitions: int,
    columns: list[str] | None = None,
) -> DataFrame:
    """Relational table read in parallel key ranges."""
    df = spark.read.jdbc(
        url, name, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions
    )
    return df.select(*columns) if columns else df


def page_schema(record: T.StructType) -> T.StructType:
    """Envelope of one page of a paged API answer."""
    return T.StructType([
        T.StructField("page", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("data", T.ArrayType(record)),
        T.StructField("next_page_url", T.StringType()),
    ])


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record of the landed pages."""
    return pages.select("page", F.explode("data").alias("_r")).select("page", "_r.*")


def page_completeness(pages: DataFrame) -> DataFrame:
    """Are all announced pages there? One row."""
    return pages.agg(
        F.countDistinct("page").alias("pages_landed"),
        F.max("total_pages").alias("pages_announced"),
        F.sum(F.size("data")).cast("bigint").alias("records"),
    ).withColumn(
        "is_complete", F.when(F.col("pages_landed") == F.col("pages_announced"), 1).otherwise(0)
    )


def with_technical_columns(df: DataFrame, run_ts: str, pipeline_id: str) -> DataFrame:
    """Add load time, source file and pipeline id to a file-based read."""
    return df.select(
        "*",
        F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at"),
        F.col("_metadata.file_path").alias("input_file"),
        F.lit(pipeline_id).alias("pipeline_id"),
    )
