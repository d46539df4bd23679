import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger


def ready(spark, *epochs):
    return spark.createDataFrame([(e, f"/in/ts={e}") for e in epochs], "bucket_ts bigint, path string")


def entry(frame, batch_id):
    at = F.timestamp_seconds(F.lit(batch_id * 100))
    return frame.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "loaded_at": at, "finished_at": at})


def epochs(frame):
    return sorted(r["bucket_ts"] for r in frame.collect())


def test_difference(spark):
    assert epochs(ledger.pending(ready(spark, 1, 2, 3), ready(spark, 2))) == [1, 3]


def test_difference_is_by_name(spark):
    again = spark.createDataFrame([(2, "/other/ts=2")], "bucket_ts bigint, path string")
    assert epochs(ledger.pending(again, ready(spark, 2))) == []


def test_late_bucket_is_pending(spark):
    assert epochs(ledger.pending(ready(spark, 1, 9), ready(spark, 9))) == [1]


def test_batches_skip_processed_ones(spark):
    waiting = ledger.pending(ready(spark, 1, 2, 3, 4, 5), ready(spark, 2))
    got = {r["bucket_ts"]: r["batch_id"] for r in ledger.batches(waiting, 2).collect()}
    assert got == {1: 0, 3: 0, 4: 1, 5: 1}
    assert [r["bucket_ts"] for r in ledger.next_batch(waiting, 2).collect()] == [1, 3]


def test_batches_follow_path_text(spark):
    rows = [(9, "/a/ts=9"), (10, "/a/ts=10"), (1, "/b/ts=1")]
    frame = spark.createDataFrame(rows, "bucket_ts bigint, path string")
    got = {r["bucket_ts"]: r["batch_id"] for r in ledger.batches(frame, 1).collect()}
    assert got == {10: 0, 9: 1, 1: 2}


def test_many_batches(spark):
    frame = ready(spark, *range(1_000_000, 1_003_000))
    got = {r["bucket_ts"]: r["batch_id"] for r in ledger.batches(frame, 7).collect()}
    assert got == {e: i // 7 for i, e in enumerate(range(1_000_000, 1_003_000))}


def test_one_entry_per_name(spark):
    twice = ready(spark, 1, 2).union(spark.createDataFrame([(1, "/z/ts=1")], "bucket_ts bigint, path string"))
    assert sorted(tuple(r) for r in ledger.unique_buckets(twice).collect()) == [(1, "/in/ts=1"), (2, "/in/ts=2")]


def test_marking_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).count() == 0
    ledger.mark_processed(entry(ready(spark, 1, 2), 1), path)
    ledger.mark_processed(entry(ready(spark, 1, 2, 3), 2), path)
    ledger.mark_processed(entry(ready(spark, 1, 2, 3), 3), path)
    got = {r["bucket_ts"]: r["batch_id"] for r in ledger.read_ledger(spark, path).collect()}
    assert got == {1: 1, 2: 1, 3: 2}
    log = {r["iteration"]: r["n_buckets"] for r in ledger.load_log(ledger.read_ledger(spark, path)).collect()}
    assert log == {1: 2, 2: 1}
