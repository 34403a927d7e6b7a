"""Incremental runs as a Structured Streaming query.

Each run of the job receives a manifest (the "next run" file list). Manifest
JSON files dropped into a folder are a file stream; every micro-batch of new
manifest records runs the job (``run_manifest``) through ``foreachBatch``.
The stream checkpoint records which manifest files were processed. A batch can
still run more than once (after a failure between its writes and the checkpoint);
each batch therefore keeps its eligibility decisions (J1, J2) in a folder of its
own, writes sheets over and replaces its own status folder, so that a repeated
batch leaves the same files as one. Files whose sheet an earlier batch wrote are
skipped by J2 as in a single run. ``availableNow`` turns the stream into a
scheduled incremental batch: process what arrived, then stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..params import JobParams
from ..plans.run import run_manifest
from ..sources.manifest import MANIFEST_SCHEMA


def manifest_stream(spark: SparkSession, manifest_dir: str, multi_line: bool = True) -> DataFrame:
    """Manifest records from every new JSON file in ``manifest_dir``."""
    docs = (spark.readStream.schema(MANIFEST_SCHEMA).option("multiLine", multi_line)
            .option("pathGlobFilter", "*.json").json(manifest_dir))
    return docs.select(
        "tenant_bridge_id", F.input_file_name().alias("manifest_file"),
        F.posexplode("files").alias("manifest_ord", "f"),
    ).select("tenant_bridge_id", "manifest_file", "manifest_ord", "f.file_name", "f.document_id",
             "f.original_file_name", "f.display_id")


def start_incremental(spark: SparkSession, manifest_dir: str, source_root: str, dest_root: str,
                      status_root: str, checkpoint: str, params: JobParams,
                      available_now: bool = True) -> StreamingQuery:
    """Start the stream; each batch writes sheets (K1) to ``dest_root`` and the
    status rows and run record of that batch under ``status_root``."""

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        res = run_manifest(batch.sparkSession, batch, source_root, dest_root, params,
                           decisions=f"{status_root}/decisions/batch_id={batch_id}")
        res.status.write.mode("overwrite").parquet(f"{status_root}/status/batch_id={batch_id}")
        res.record.write.mode("overwrite").json(f"{status_root}/run_record/batch_id={batch_id}")

    writer = manifest_stream(spark, manifest_dir).writeStream.foreachBatch(run_batch).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
