"""Raw files derived from the given tables, in the layout of each source style."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.session import scratch_path
from sedimenta.sources import entities, formats, readers

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
RECORDS_PER_DOCUMENT = 5_000
PAGE_SIZE = 50
#: Rows of a compressed file, which one task reads.
FILE_ROWS = 1_000_000


def app_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their time as ISO text, as files carry it."""
    return entities.events(spark, sf).select(
        "event_id", "user_id", "event_type", F.date_format("ts", ISO).alias("timestamp"), "value"
    )


def typed(events: DataFrame) -> DataFrame:
    """File events with a real time column."""
    return events.withColumn("ts", F.to_timestamp_ntz("timestamp")).drop("timestamp")


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery status messages: the key is the user's running delivery, replaced by each message."""
    kind = F.col("event_type")
    return app_events(spark, sf).select(
        F.col("user_id").alias("delivery_id"), "event_id",
        F.when(kind == "purchase", "DELIVERED").when(kind == "view", "PICKED").otherwise("ASSIGNED").alias("status"),
        F.concat(F.lit("Street "), F.col("user_id").cast("string")).alias("delivery_address"),
        "value", "timestamp",
    )


def landed_csv(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "csv")
    df.write.option("header", True).csv(path)
    return readers.csv_table(spark, path, df.schema)


def landed_ndjson(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "ndjson")
    df.write.json(path)
    return path


def landed_rows(df: DataFrame, path: str) -> None:
    """Add newline JSON files to a folder; compressed, as their text is several times the size of the rows."""
    df.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(path)


def landed_documents(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    formats.land_json_documents(df, key, RECORDS_PER_DOCUMENT, path)
    return readers.json_documents(spark, path, df.schema)


def landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    payments = entities.payments(spark, sf)
    formats.land_pages(payments, "order_id", PAGE_SIZE, "/api/v1/payments", path)
    return readers.ndjson_table(spark, path, readers.page_schema(T.StructType(payments.schema.fields)))
