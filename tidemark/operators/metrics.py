"""Load metrics as tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.deltas import DeltaTable
from tidemark.operators.ranking import with_position

# --- fixed values: metric names and the window of the load-time mean --------------
APPLICATION_ID = "ApplicationID"
LOCATION_UPDATED = "CellLocLastUpdate"
MEAN_LOAD_TIME = "AvgBucketProcessTime"
CURRENT_PATH = "CurrentProcessPath"
CURRENT_TS = "CurrentProcessTS"
DELAY_OVERALL = "DelayOverallHBaseLoad"
DELAY_LOADER = "DelayBulkLoader"
BUCKETS_AHEAD = "NumberOfUnprocessedBucketsAhead"
READY_COUNT = "ZnodesInReady"
PROCESSED_COUNT = "ZnodesInProcessed"
LAST_PATH = "lastProcessedPath"
LAST_TS = "lastProcessedTS"
LAST_LOAD_TIME = "lastProcessTime"
TRAILING_LOADS = 12
# ----------------------------------------------------------------------------------

METRICS_SCHEMA = "name string, value string, updated_at timestamp"


def load_time(started: Column, finished: Column, n_buckets: Column) -> Column:
    """Whole seconds per bucket; a batch without buckets counts as one."""
    return F.call_function("div", finished - started, F.greatest(n_buckets, F.lit(1)))


def load_times(load_log: DataFrame) -> DataFrame:
    spent = load_time(F.col("started"), F.col("finished"), F.col("n_buckets"))
    return load_log.select("iteration", spent.alias("load_time"))


def trailing_load_mean(load_log: DataFrame, window: int = TRAILING_LOADS) -> DataFrame:
    """Whole-second mean of the last ``window`` load times before each iteration.

    Each load adds its time to the ``window`` loads after it, so the work is a
    grouped sum of bounded groups and not one ordered pass over the whole log.
    """
    timed = with_position(load_times(load_log), ["iteration"])
    later = F.explode(F.sequence(F.col("position") + 1, F.col("position") + window))
    sums = (
        timed.select(later.alias("position"), "load_time")
        .groupBy("position")
        .agg(F.sum("load_time").alias("_sum"), F.count("*").alias("_loads"))
    )
    mean = F.call_function("div", F.col("_sum"), F.col("_loads"))
    return timed.join(sums, "position", "left").select("iteration", mean.alias("mean_load_time"))


def buckets_ahead(buckets: DataFrame) -> DataFrame:
    """For each listed bucket, how many listed buckets have a greater epoch: its place
    from the newest end, less one. Equal epochs share the first place."""
    newest_first = buckets.select("bucket_ts", (-F.col("bucket_ts")).alias("_age"))
    placed = with_position(newest_first, ["_age"])
    return placed.groupBy("bucket_ts").agg((F.min("position") - 1).alias("ahead"))


def bucket_lag(started: Column, bucket_ts: Column) -> list[Column]:
    """Seconds from bucket epoch to load start, under its two names."""
    lag = started - bucket_ts
    return [lag.alias(DELAY_OVERALL), lag.alias(DELAY_LOADER)]


def ledger_counts(ready: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows of both lists under their metric names."""
    return (
        ready.select(F.lit(READY_COUNT).alias("name"))
        .unionAll(processed.select(F.lit(PROCESSED_COUNT).alias("name")))
        .groupBy("name")
        .agg(F.count("*").alias("entries"))
    )


def batch_summary(buckets: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Paths and epochs of each batch as comma lists; a batch has few buckets."""
    text = lambda name: F.concat_ws(",", F.array_sort(F.collect_list(F.col(name).cast("string"))))
    return buckets.groupBy(batch).agg(
        text("path").alias(LAST_PATH), text("bucket_ts").alias(LAST_TS)
    )


def latest(metrics: DataFrame) -> DataFrame:
    """The last value written under each name; one of equal age is chosen by its text."""
    newest = F.max(F.struct("updated_at", "value"))
    return metrics.groupBy("name").agg(newest.alias("m")).select("name", "m.value", "m.updated_at")


def metrics_table(spark: SparkSession, path: str) -> DeltaTable:
    """The sink: appended values, of which a merge keeps the latest one of each name."""
    return DeltaTable(spark, path, METRICS_SCHEMA, latest, fold_after=32)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return latest(metrics_table(spark, path).read())


def write_metrics(spark: SparkSession, path: str, values: dict[str, object], fold: bool = True) -> None:
    """Append current values; ``latest`` makes the newest one visible. With ``fold`` it is seen to that files don't pile up."""
    at = datetime.now(UTC)
    sink = metrics_table(spark, path)
    sink.append([(name, str(value), at) for name, value in values.items() if value is not None])
    if fold:
        sink.fold()


def recent_loads(load_log: DataFrame, window: int = TRAILING_LOADS) -> DataFrame:
    """The newest ``window`` loads with their load times: a distributed top-k."""
    recent = load_log.orderBy(F.desc("iteration")).limit(window)
    spent = load_time(F.col("started"), F.col("finished"), F.col("n_buckets"))
    return recent.select("iteration", spent.alias("load_time"))
