"""Ready and processed buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.deltas import DeltaTable
from tidemark.operators.ranking import with_position

LEDGER_SCHEMA = (
    "bucket_ts bigint, path string, batch_id bigint, loaded_at timestamp, finished_at timestamp, "
    "seen bigint, dropped bigint, too_long bigint"
)
LEDGER_COLUMNS = ["bucket_ts", "path", "batch_id", "loaded_at", "finished_at"]
LOAD_COUNTS = ["seen", "dropped", "too_long"]
"""Lines of the whole load; each of its buckets' rows has them. Null where a writer kept none."""


def unique_buckets(ready: DataFrame) -> DataFrame:
    """One row per bucket name, however often its reference was written."""
    return ready.groupBy("bucket_ts").agg(F.min("path").alias("path"))


def pending(ready: DataFrame, processed: DataFrame) -> DataFrame:
    """Ready buckets the ledger does not hold. Decided by name only: an older bucket
    that turns up late is pending, a processed one that is sent again is not."""
    return ready.join(processed.select("bucket_ts"), "bucket_ts", "left_anti")


def next_batch(buckets: DataFrame, size: int) -> DataFrame:
    """The first ``size`` buckets by path text (a distributed top-k)."""
    return buckets.orderBy("path").limit(size)


def batches(buckets: DataFrame, size: int) -> DataFrame:
    """All buckets in path order with the number of the batch that takes them."""
    placed = with_position(buckets, ["path"])
    batch = F.call_function("div", F.col("position") - 1, F.lit(size))
    return placed.select(*buckets.columns, batch.alias("batch_id"))


def ledger_table(spark: SparkSession, path: str) -> DeltaTable:
    return DeltaTable(spark, path, LEDGER_SCHEMA)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return ledger_table(spark, path).read()


def load_log(processed: DataFrame) -> DataFrame:
    """One row per load, from the rows it left in the ledger."""
    return processed.groupBy(F.col("batch_id").alias("iteration")).agg(
        F.unix_seconds(F.min("loaded_at")).alias("started"),
        F.unix_seconds(F.max("finished_at")).alias("finished"),
        F.count("*").cast("int").alias("n_buckets"),
    )


def mark_processed(loaded: DataFrame | Sequence[tuple], path: str, spark: SparkSession | None = None) -> None:
    """Append one row per bucket; buckets the ledger holds already are left alone.

    ``loaded`` is a frame with the ledger's columns, the load counts or not; or the few rows of a batch (with ``spark``) whose
    buckets are claimed and known to be missing. The rows are written as one file, so that they become
    visible together. Jobs that share a ledger claim buckets before they load them.
    """
    if not isinstance(loaded, DataFrame):
        ledger_table(spark, path).append(loaded)
        return
    counts = [
        (F.col(c) if c in loaded.columns else F.lit(None)).cast("bigint").alias(c) for c in LOAD_COUNTS
    ]
    known = ledger_table(loaded.sparkSession, path)
    known.append(pending(loaded, known.read()).select(*LEDGER_COLUMNS, *counts))
