"""The run manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = (
    "tenant_bridge_id string, last_run_on_utc string, "
    "files array<struct<file_name:string, document_id:string, original_file_name:string, display_id:string>>"
)


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per manifest file record, with its position in its manifest
    (`manifest_ord`). ``multi_line`` reads whole-file JSON objects (the REST
    reply saved as a file); otherwise JSON lines, one manifest object per line,
    which splits across tasks."""
    doc = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", multi_line).json(path)
    return doc.select("tenant_bridge_id", "last_run_on_utc", F.posexplode("files").alias("manifest_ord", "f")).select(
        "tenant_bridge_id", "last_run_on_utc", "manifest_ord",
        F.col("f.file_name").alias("file_name"), F.col("f.document_id").alias("document_id"),
        F.col("f.original_file_name").alias("original_file_name"), F.col("f.display_id").alias("display_id"),
    )
