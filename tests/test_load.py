import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import enrich, ledger, metrics, table
from tidemark.plans.load import LoadJob
from tidemark.settings import LoadSettings
from tidemark.sources import manifest
from tidemark.streaming.load_stream import start_load_stream

numbers = itertools.count()
EPOCHS = [1517805000 + 1800 * i for i in range(5)]


class Inbox:
    """Bucket folders with two good lines, one bad one and a copy each."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def add(self, epoch, lines=None):
        folder = self.root / f"ts={epoch}"
        folder.mkdir(parents=True, exist_ok=True)
        if lines is None:
            lines = [f"{epoch}\t{u}\tx\tpay{u}" for u in (12, 345)]
            lines += [f"{epoch}\t12\tx\tpay12\tn", "bad"]
        (folder / "data.txt").write_text("".join(f"{line}\n" for line in lines))
        return (epoch, str(folder))

    def ready(self, entries):
        return self.spark.createDataFrame(entries, "bucket_ts bigint, path string")


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path / "in")


@pytest.fixture
def make_settings(tmp_path):
    def make(**more):
        number = next(numbers)
        return LoadSettings(
            **{"table": f"load_{number}", "root": str(tmp_path / f"t{number}"), "regions": 10, "buckets_per_load": 2, **more}
        )

    return make


def stored(spark, settings):
    frame = spark.table(settings.table).select("bucket_ts", "region", "userid_ts", "payload")
    return sorted(tuple(r) for r in frame.collect())


def expected(*epochs):
    want = []
    for e in epochs:
        want += [(e, 2, f"21-{e}", "pay12")] * 2 + [(e, 5, f"543-{e}", "pay345")]
    return sorted(want)


def test_batches_of_buckets(spark, inbox, make_settings):
    settings = make_settings()
    entries = [inbox.add(e) for e in EPOCHS]
    results = LoadJob(spark, settings).run(lambda: inbox.ready(entries))
    assert [(r.batch_id, r.buckets, r.seen, r.dropped) for r in results] == [(1, 2, 8, 2), (2, 2, 8, 2), (3, 1, 4, 1)]
    assert stored(spark, settings) == expected(*EPOCHS)
    processed = ledger.read_ledger(spark, settings.ledger_path)
    assert {r["bucket_ts"]: r["batch_id"] for r in processed.collect()} == dict(zip(EPOCHS, [1, 1, 2, 2, 3]))
    values = {r["name"]: r["value"] for r in metrics.read_metrics(spark, settings.metrics_path).collect()}
    assert values["ZnodesInReady"] == values["ZnodesInProcessed"] == "5"
    assert values["lastProcessedTS"] == str(EPOCHS[-1])
    assert values["NumberOfUnprocessedBucketsAhead"] == "0"
    assert values["CurrentProcessPath"] == entries[-1][1]
    assert values["DelayBulkLoader"] == values["DelayOverallHBaseLoad"]
    assert values["ApplicationID"] == spark.sparkContext.applicationId
    assert {"AvgBucketProcessTime", "lastProcessTime", "lastProcessedPath", "CurrentProcessTS"} <= set(values)
    served = {r["userid_ts"]: r["payload"] for r in spark.table(f"{settings.table}_view").collect()}
    assert len(served) == 10


def test_restart_loads_nothing_again(spark, inbox, make_settings):
    settings = make_settings()
    entries = [inbox.add(e) for e in EPOCHS[:2]]
    assert len(LoadJob(spark, settings).run(lambda: inbox.ready(entries))) == 1
    inbox.add(EPOCHS[0], [f"{EPOCHS[0]}\t9\tx\tchanged"])
    assert LoadJob(spark, settings).run(lambda: inbox.ready(entries)) == []
    assert stored(spark, settings) == expected(*EPOCHS[:2])


@pytest.mark.parametrize("step", ["publish", "mark_processed"])
def test_failed_load_leaves_no_ledger_row(spark, inbox, make_settings, monkeypatch, step):
    settings = make_settings()
    entry = inbox.add(EPOCHS[0], [f"{EPOCHS[0]}\t77\tx\tearlier content"])
    job = LoadJob(spark, settings)

    def fail(*_args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table if step == "publish" else ledger, step, fail)
        with pytest.raises(RuntimeError):
            job.load(inbox.ready([entry]))
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 0
    inbox.add(EPOCHS[0])
    assert LoadJob(spark, settings).load(inbox.ready([entry])).buckets == 1
    assert stored(spark, settings) == expected(EPOCHS[0])


def test_missing_folder_fails(spark, inbox, make_settings):
    settings = make_settings()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        LoadJob(spark, settings).load(inbox.ready([(1800, f"{inbox.root}/ts=1800")]))
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 0


@pytest.mark.parametrize("lines", [[], ["bad", "worse"]])
def test_bucket_without_rows_is_marked(spark, inbox, make_settings, lines):
    settings = make_settings()
    result = LoadJob(spark, settings).load(inbox.ready([inbox.add(EPOCHS[0], lines)]))
    assert (result.seen, result.dropped) == (len(lines), len(lines))
    assert stored(spark, settings) == []
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 1


def test_keys_that_are_too_long_are_counted(spark, inbox, make_settings):
    settings = make_settings()
    lines = [f"{EPOCHS[0]}\t{'9' * 40_000}\tx\tp", f"{EPOCHS[0]}\t1\tx\tp", "bad"]
    result = LoadJob(spark, settings).load(inbox.ready([inbox.add(EPOCHS[0], lines)]))
    assert (result.seen, result.dropped, result.too_long) == (3, 1, 1)
    assert stored(spark, settings) == [(EPOCHS[0], 1, f"1-{EPOCHS[0]}", "p")]


def test_datatype2_counts_and_marks(spark, inbox, make_settings):
    settings = make_settings(mode="datatype2")
    result = LoadJob(spark, settings).load(inbox.ready([inbox.add(EPOCHS[0], ["a\tb", "a", "a\tb\tc\td", "a\tb\tc"])]))
    assert (result.seen, result.dropped) == (4, 2)
    assert stored(spark, settings) == []
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 1


def test_location_is_resolved_and_refreshed(spark, inbox, make_settings):
    settings = make_settings(resolve_location=True, buckets_per_load=1)
    reads, now = [], [10**9]

    def dimension():
        reads.append(1)
        return spark.createDataFrame([("21", f"home{len(reads)}")], "user string, location string")

    def locate(keyed, location):
        user = F.substring_index("userid_ts", "-", 1).alias("user")
        return enrich.with_location(
            keyed.select("*", user), location.frame, on=["user"], broadcast=location.broadcast
        ).drop("user")

    job = LoadJob(spark, settings, dimension, locate, clock=lambda: now[0])
    job.load(inbox.ready([inbox.add(EPOCHS[0])]))
    now[0] += 24 * 3600 + 1
    job.load(inbox.ready([inbox.add(EPOCHS[1])]))
    got = {(r["userid_ts"], r["location_history"]) for r in spark.table(settings.table).collect()}
    assert got == {
        (f"21-{EPOCHS[0]}", "home1"), (f"543-{EPOCHS[0]}", None),
        (f"21-{EPOCHS[1]}", "home2"), (f"543-{EPOCHS[1]}", None),
    }
    values = {r["name"]: r["value"] for r in metrics.read_metrics(spark, settings.metrics_path).collect()}
    assert values["CellLocLastUpdate"] == str(now[0])
    with pytest.raises(ValueError):
        LoadJob(spark, make_settings(resolve_location=True))


def test_stream_equals_batch_and_loads_late_buckets_once(spark, inbox, make_settings, tmp_path):
    batch, stream = make_settings(), make_settings()
    entries = [inbox.add(e) for e in EPOCHS]
    LoadJob(spark, batch).run(lambda: inbox.ready(entries))
    listing, checkpoint = str(tmp_path / "ready"), str(tmp_path / "offsets")
    manifest.announce(inbox.ready(entries[2:]), listing)
    start_load_stream(LoadJob(spark, stream), listing, checkpoint).awaitTermination()
    assert stored(spark, stream) == expected(*EPOCHS[2:])
    manifest.announce(inbox.ready(entries[:2] + [(EPOCHS[4], entries[0][1])]), listing)
    start_load_stream(LoadJob(spark, stream), listing, checkpoint).awaitTermination()
    loads = ledger.load_log(ledger.read_ledger(spark, stream.ledger_path)).collect()
    # an entry sent again takes a place in its micro-batch, so a load may be smaller
    sizes = [r["n_buckets"] for r in loads]
    assert sum(sizes) == 5 and max(sizes) <= 2
    assert stored(spark, stream) == stored(spark, batch) == expected(*EPOCHS)
    start_load_stream(LoadJob(spark, stream), listing, checkpoint).awaitTermination()
    assert ledger.read_ledger(spark, stream.ledger_path).count() == 5


def test_entry_with_another_buckets_folder_is_refused(spark, inbox, make_settings):
    settings = make_settings()
    _, path = inbox.add(EPOCHS[0])
    with pytest.raises(ValueError, match="another bucket"):
        LoadJob(spark, settings).load(inbox.ready([(EPOCHS[1], path)]))
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 0


def test_stream_keeps_going_and_survives_a_failure(spark, inbox, make_settings, tmp_path, monkeypatch):
    settings = make_settings()
    listing, checkpoint = str(tmp_path / "ready"), str(tmp_path / "offsets")
    manifest.announce(inbox.ready([inbox.add(EPOCHS[0])]), listing)

    def fail(*_args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "mark_processed", fail)
        with pytest.raises(Exception, match="lost"):
            start_load_stream(LoadJob(spark, settings), listing, checkpoint).awaitTermination()
    query = start_load_stream(LoadJob(spark, settings), listing, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        assert stored(spark, settings) == expected(EPOCHS[0])
        manifest.announce(inbox.ready([inbox.add(EPOCHS[1])]), listing)
        query.processAllAvailable()
    finally:
        query.stop()
    assert stored(spark, settings) == expected(*EPOCHS[:2])
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 2


def test_arrival_order_does_not_matter(spark, inbox, make_settings):
    entries = [inbox.add(e) for e in EPOCHS[:3]]
    forward, backward = make_settings(buckets_per_load=3), make_settings(buckets_per_load=1)
    LoadJob(spark, forward).run(lambda: inbox.ready(entries))
    job = LoadJob(spark, backward)
    for entry in reversed(entries):
        job.load(inbox.ready([entry]))
    assert stored(spark, forward) == stored(spark, backward)


@pytest.mark.parametrize("change", [lambda f: f.where("userid_ts LIKE '21%'"), lambda f: f.unionAll(f)])
def test_step_that_changes_the_row_count_fails_the_load(spark, inbox, make_settings, change):
    settings = make_settings(resolve_location=True)
    places = spark.createDataFrame([("21", "home")], "user string, location string")

    def locate(keyed, location):
        return change(keyed.withColumn("location_history", F.lit(None).cast("string")))

    job = LoadJob(spark, settings, lambda: places, locate)
    with pytest.raises(RuntimeError, match="are stored of 3"):
        job.load(inbox.ready([inbox.add(EPOCHS[0])]))
    assert ledger.read_ledger(spark, settings.ledger_path).count() == 0


def test_job_frees_what_has_expired(spark, inbox, make_settings):
    settings, now = make_settings(ttl_seconds=7200, buckets_per_load=1), [10**9]
    job = LoadJob(spark, settings, clock=lambda: now[0])
    for epoch in EPOCHS[:3]:
        job.load(inbox.ready([inbox.add(epoch)]))
        now[0] += 3601
    # the first load is 7202 seconds old when the third frees what has expired
    assert stored(spark, settings) == expected(*EPOCHS[1:3])
    assert [r[0] for r in spark.read.parquet(settings.expired_path).collect()] == [EPOCHS[0]]
    assert LoadJob(spark, settings, clock=lambda: now[0]).load(inbox.ready([inbox.add(EPOCHS[0])])) is None


def test_ledger_keeps_the_counts_of_a_load(spark, inbox, make_settings):
    settings = make_settings()
    LoadJob(spark, settings).load(inbox.ready([inbox.add(e) for e in EPOCHS[:2]]))
    kept = ledger.read_ledger(spark, settings.ledger_path).select(*ledger.LOAD_COUNTS).collect()
    assert [tuple(r) for r in kept] == [(8, 2, 0)] * 2
