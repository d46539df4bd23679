"""The ready list: one entry per bucket, named by epoch, holding the folder path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import many_folders

MANIFEST_SCHEMA = "value string, bucket_ts bigint"
READY_SCHEMA = "bucket_ts bigint, path string"


def announce(buckets: DataFrame, manifest: str) -> None:
    """Add ready entries for (``bucket_ts``, ``path``), one file each."""
    entries = buckets.select(F.col("path").alias("value"), "bucket_ts")
    with many_folders(buckets.sparkSession):
        spread = entries.hint("rebalance", "bucket_ts")
        spread.write.mode("append").partitionBy("bucket_ts").text(manifest)


def read_ready(spark: SparkSession, manifest: str) -> DataFrame:
    entries = spark.read.schema(MANIFEST_SCHEMA).text(manifest)
    return entries.select("bucket_ts", F.col("value").alias("path"))


def stream_ready(
    spark: SparkSession, manifest: str, buckets_per_load: int, archive: str | None = None
) -> DataFrame:
    """New ready entries as they appear; one file is one bucket, so the file limit
    bounds the buckets of a micro-batch (an entry sent again counts too). Old entries are
    never skipped. With ``archive`` the entries of finished micro-batches move there, so that a trigger lists only what
    it has not handled; a file that is moved in the meantime is not missed."""
    reader = (
        spark.readStream.schema(MANIFEST_SCHEMA)
        .option("maxFilesPerTrigger", buckets_per_load)
        .option("maxFileAge", "36500d")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    entries = reader.text(manifest)
    return entries.select("bucket_ts", F.col("value").alias("path"))
