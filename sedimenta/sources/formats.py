"""Format conversion, landing helpers and size reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.regression import compare_to_golden


def write_as(df: DataFrame, fmt: str, path: str) -> None:
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    writer.format(fmt).save(path)


def read_as(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)


def convert(df: DataFrame, root: str, formats: tuple[str, ...] = ("csv", "json", "parquet")) -> dict[str, str]:
    """Write one frame in several formats; returns the path of each."""
    paths = {fmt: f"{root}/{fmt}" for fmt in formats}
    for fmt, path in paths.items():
        write_as(df, fmt, path)
    return paths


def conversion_report(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Rows of every copy and how many differ when it is read back with the original schema."""

    def one(fmt: str, path: str) -> DataFrame:
        verdict = compare_to_golden(read_as(df.sparkSession, fmt, path, df.schema), df)
        return verdict.select(
            F.lit(fmt).alias("format"),
            F.col("actual_rows").alias("row_count"),
            (F.col("missing_rows") + F.col("unexpected_rows")).alias("differing_rows"),
        )

    return reduce(DataFrame.unionByName, [one(f, p) for f, p in paths.items()])


def size_report(spark: SparkSession, root: str, formats: tuple[str, ...], baseline: str = "csv") -> DataFrame:
    """Stored bytes of each copy below ``root``, and the baseline's size relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    stored = {f: F.sum(F.when(F.col("path").contains(f"/{f}/"), F.col("length"))).alias(f) for f in formats}
    rows = [F.struct(F.lit(f).alias("format"), F.col(f).alias("bytes"), F.col(baseline).alias("base")) for f in formats]
    return (
        files.agg(*stored.values())
        .select(F.explode(F.array(*rows)).alias("r"))
        .select("r.format", "r.bytes", F.round(F.col("r.base") / F.col("r.bytes"), 2).alias("baseline_ratio"))
    )


def land_json_documents(df: DataFrame, key: str, per_document: int, path: str) -> None:
    """Write JSON array documents of at most ``per_document`` consecutive keys, one per file."""
    doc = F.floor(F.col(key) / per_document).cast("bigint").alias("doc")
    (
        df.groupBy(doc)
        .agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
        .repartition("doc")
        .write.partitionBy("doc")
        .text(path)
    )


def land_pages(df: DataFrame, key: str, page_size: int, endpoint: str, path: str) -> None:
    """Write paged API answers, one page per line; a page holds ``page_size`` consecutive keys."""
    page = (F.floor(F.col(key) / page_size) + 1).cast("bigint").alias("page")
    total = df.agg((F.floor(F.max(key) / page_size) + 1).cast("bigint"))
    (
        df.groupBy(page)
        .agg(F.collect_list(F.struct(*df.columns)).alias("data"))
        .withColumn("total_pages", total.scalar())
        .withColumn(
            "next_page_url",
            F.when(
                F.col("page") < F.col("total_pages"),
                F.concat(F.lit(f"{endpoint}?page="), (F.col("page") + 1).cast("string")),
            ),
        )
        .write.json(path)
    )
