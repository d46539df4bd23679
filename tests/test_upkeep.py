"""What keeps a table in order over many loads: claims, small tables, live regions, merged buckets, keyed SQL reads."""

import itertools
import threading
from unittest import mock

import pytest
from pyspark.sql import functions as F

from tidemark.operators import compaction, enrich, ledger, metrics, region_set, table
from tidemark.operators.claims import Claims, Failures, held
from tidemark.operators.deltas import DeltaTable
from tidemark.operators.region_set import RegionSet
from tidemark.plans.load import LoadJob
from tidemark.settings import LoadSettings
from tidemark.shared import create_file, file_names
from tidemark.sources import manifest
from tidemark.sources.dimension import location_of_settings
from tidemark.streaming.load_stream import start_load_stream

numbers = itertools.count()
EPOCHS = [1517805000 + 1800 * i for i in range(12)]


@pytest.fixture
def settings(tmp_path):
    def make(**more):
        n = next(numbers)
        defaults = {"table": f"upkeep_{n}", "root": str(tmp_path / f"t{n}"), "regions": 10, "buckets_per_load": 1}
        return LoadSettings(**{**defaults, **more})

    return make


@pytest.fixture
def inbox(spark, tmp_path):
    def add(epoch, lines):
        folder = tmp_path / "in" / f"ts={epoch}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "x.txt").write_text("".join(f"{line}\n" for line in lines))
        return (epoch, str(folder))

    def ready(entries):
        return spark.createDataFrame(entries, "bucket_ts bigint, path string")

    add.ready = ready
    return add


def line(ts, user, payload):
    return f"{ts}\t{user}\tx\t{payload}"


def served(spark, settings):
    return sorted(tuple(r) for r in spark.table(f"{settings.table}_view").collect())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- claims --------------------------------------------------------------------------


def test_one_of_many_creates_a_file(spark, tmp_path):
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append(create_file(spark, str(tmp_path / "one"), b"%d" % k))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 7 + [True]


def test_claims_and_leases(spark, tmp_path):
    now = [1000.0]
    one, two = (Claims(spark, str(tmp_path / "c"), 60, lambda: now[0]) for _ in range(2))
    assert one.take(5) and one.take(5) and not two.take(5)
    assert two.held_by_others() == {"5"} and one.held_by_others() == set()
    two.release([5])
    assert not two.take(5)
    now[0] += 61
    assert two.held_by_others() == set() and two.take(5) and not one.take(5)
    two.release([5])
    assert one.take(5)
    (tmp_path / "c" / "6").write_bytes(b"")  # its owner died between creating and writing
    assert not one.take(6)
    with held(spark, str(tmp_path), "x", 60) as first, held(spark, str(tmp_path), "x", 60) as second:
        assert (first, second) == (True, False)


def test_two_jobs_load_each_bucket_once(spark, inbox, settings):
    made = settings(buckets_per_load=2, split_every=0)
    entries = [inbox(e, [line(e, 12, "a"), line(e, 34, "b")]) for e in EPOCHS[:6]]
    jobs = [LoadJob(spark, made) for _ in range(2)]
    done = [[], []]

    def work(k):
        done[k] = jobs[k].run(lambda: inbox.ready(entries))

    threads = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = ledger.read_ledger(spark, made.ledger_path).collect()
    assert sorted(r["bucket_ts"] for r in rows) == EPOCHS[:6]
    assert sum(r.buckets for d in done for r in d) == 6
    ids = [r.batch_id for d in done for r in d]
    assert len(set(ids)) == len(ids)
    assert spark.table(made.table).count() == 12
    assert [n for n in file_names(spark, made.claims_path) if not n.startswith("_")] == []


def test_a_number_given_meanwhile_is_not_given_again(spark, inbox, settings):
    made = settings(buckets_per_load=1, split_every=0)
    entries = [inbox(e, [line(e, 12, "a")]) for e in EPOCHS[:2]]
    one, two = (LoadJob(spark, made) for _ in range(2))
    write, done = one._write, []

    def while_the_other_loads(*args):
        done.append(two.load(inbox.ready(entries)))
        return write(*args)

    one._write = while_the_other_loads
    done.append(one.load(inbox.ready(entries)))
    assert sorted(r.batch_id for r in done) == [1, 2]
    assert sorted(r["batch_id"] for r in ledger.read_ledger(spark, made.ledger_path).collect()) == [1, 2]


def test_a_claimed_bucket_is_left_alone(spark, inbox, settings):
    made = settings(buckets_per_load=2)
    entries = [inbox(e, [line(e, 12, "a")]) for e in EPOCHS[:2]]
    other = Claims(spark, made.claims_path)
    other.take(EPOCHS[0])
    job = LoadJob(spark, made)
    assert [r.buckets for r in job.run(lambda: inbox.ready(entries))] == [1]
    other.release([EPOCHS[0]])
    assert [r.buckets for r in job.run(lambda: inbox.ready(entries))] == [1]


# --- small tables ----------------------------------------------------------------------


def test_reads_open_a_bounded_number_of_files(spark, tmp_path):
    known = DeltaTable(spark, str(tmp_path / "d"), "name string, n bigint", fold_after=16)
    for k in range(300):
        known.append([(f"x{k % 7}", k)])
        known.fold()
        assert len(known.files()) <= 17
    assert sorted(r["n"] for r in known.read().collect()) == list(range(300))
    assert sorted(n for _, n in known.rows()) == list(range(300))
    assert len(file_names(spark, known.path)) <= 60


def test_a_merge_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    known = DeltaTable(spark, str(tmp_path / "d"), "n bigint", fold_after=2)
    for k in range(4):
        known.append([(k,)])
    with monkeypatch.context() as patch:
        patch.setattr("tidemark.operators.deltas.create_file", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            known.fold()
    assert sorted(r[0] for r in known.read().collect()) == [0, 1, 2, 3]
    known.append(spark.createDataFrame([(9,)], "n bigint"))
    assert known.fold() and len(known.files()) == 1
    assert sorted(r[0] for r in known.read().collect()) == [0, 1, 2, 3, 9]
    assert DeltaTable(spark, str(tmp_path / "none"), "n bigint").read().count() == 0


def test_files_of_an_earlier_layout_count(spark, tmp_path):
    spark.createDataFrame([(1,), (2,)], "n bigint").coalesce(1).write.parquet(str(tmp_path / "d"))
    known = DeltaTable(spark, str(tmp_path / "d"), "n bigint", fold_after=0)
    known.append([(3,)])
    assert known.fold() and sorted(r[0] for r in known.read().collect()) == [1, 2, 3]


def test_latest_metrics_stay_through_merges(spark, tmp_path):
    for k in range(80):
        metrics.write_metrics(spark, str(tmp_path / "m"), {"a": k, "b": k if k < 5 else None})
    assert {r["name"]: r["value"] for r in metrics.read_metrics(spark, str(tmp_path / "m")).collect()} == {"a": "79", "b": "4"}
    assert len(metrics.metrics_table(spark, str(tmp_path / "m")).files()) <= 34


# --- live regions ----------------------------------------------------------------------


def test_region_tree():
    regions = RegionSet([(1, "1", None), (2, "5", None), (3, "5", 2), (4, "54", 2), (5, "54", 4), (6, "543", 4)])
    assert [(r.number, r.low, r.high, r.ancestors) for r in regions.live] == [
        (0, "", "1", ()), (1, "1", "5", ()), (3, "5", "54", (2,)), (5, "54", "543", (2, 4)), (6, "543", None, (2, 4)),
    ]
    assert regions.of("540").number == 5 and regions.of("").number == 0
    assert regions.holding("543-1", "543-1") == [2, 4, 6]
    assert regions.holding_prefix("54") == [2, 4, 5, 6] and regions.holding_prefix("1") == [1]


def test_live_bounds_leave_parents_out(spark):
    rows = spark.createDataFrame([(1, "1", None), (2, "5", None), (3, "5", 2), (4, "54", 2)], region_set.REGION_SCHEMA)
    assert [tuple(r) for r in region_set.live_bounds(rows).collect()] == [(1, "1"), (2, "5"), (3, "54")]


def test_sketches_merge_whatever_the_order(spark):
    regions = RegionSet([(1, "5", None)])
    parts = [spark.range(a, a + 4000).select(F.concat(F.lit("5"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("userid_ts"), F.lit(1).alias("region")) for a in (0, 4000, 8000)]
    stats = [region_set.region_stats(p, regions) for p in parts]
    for order in itertools.permutations(stats):
        merged = region_set.merged_stats(order[0].unionAll(order[1]).unionAll(order[2]))
        assert [(r["loads"], r["n_rows"]) for r in merged.collect()] == [(3, 12000)]
        points = region_set.split_points(merged, {1: 4})[1]
        keys = [region_set.key_at(regions.regions[1], n) for n in points]
        assert all(abs(int(k[1:].ljust(6, "0")) - want) < 400 for k, want in zip(keys, (3000, 6000, 9000)))


def test_hot_regions_are_split_and_old_buckets_read_right(spark, inbox, settings):
    """Half of all lines are of users whose keys begin alike: later loads spread them, and every read finds all buckets' rows."""
    made = settings(split_every=1, compact_units=0)
    job = LoadJob(spark, made)
    want = {}
    for k, e in enumerate(EPOCHS[:6]):
        users = [100 * s + 45 for s in range(600)] + list(range(1000, 1600))
        lines = [line(e, u, f"p{k}-{u}") for u in users]
        want.update({f"{str(u)[::-1]}-{e}": f"p{k}-{u}" for u in users})
        job.load(inbox.ready([inbox(e, lines)]))
    sizes = [r["count"] for r in spark.table(made.table).where(F.col("bucket_ts") == EPOCHS[5]).groupBy("region").count().collect()]
    first = [r["count"] for r in spark.table(made.table).where(F.col("bucket_ts") == EPOCHS[0]).groupBy("region").count().collect()]
    assert max(first) > 4 * sum(first) / 10
    assert max(sizes) < 2 * sum(sizes) / len(job.regions.live)
    assert dict((k, p) for k, p, _ in served(spark, made)) == want
    own = {k: p for k, p in want.items() if k.startswith("54321-")}
    for found in (table.user_scan(spark, made, 12345), spark.sql(f"SELECT * FROM {made.table}_user('12345')")):
        assert {r["userid_ts"]: r["payload"] for r in found.collect()} == own
    assert len(own) == 6
    at = EPOCHS[0]
    for found in (table.point_get(spark, made, 12345, at), spark.sql(f"SELECT * FROM {made.table}_get('12345', '{at}')")):
        assert [r["payload"] for r in found.collect()] == ["p0-12345"]
    start, end = EPOCHS[0] + 1, EPOCHS[2] + 1
    for found in (table.user_time_range(spark, made, 12345, start, end), spark.sql(f"SELECT * FROM {made.table}_range('12345', {start}, {end})")):
        assert found.count() == 2
    again = LoadJob(spark, made)
    assert again.regions == job.regions and again.bounds == job.bounds


def test_a_region_of_one_key_stays_whole():
    regions = RegionSet([(1, "5", None)])
    assert region_set.hot_regions({0: 0, 1: 0}, regions, 2) == {}
    assert region_set.split_rows(regions, {1: [int.from_bytes(b"5\0\0\0\0\0\0", "big")]}) == []
    most = region_set.hot_regions({0: 1, 1: 10**6}, regions, 2)
    assert most[1] <= 2 * region_set.MOST_REGIONS_FACTOR


# --- keyed SQL reads -------------------------------------------------------------------


def test_sql_reads_prune_partitions(spark, inbox, settings):
    made = settings()
    job = LoadJob(spark, made)
    job.load(inbox.ready([inbox(EPOCHS[0], [line(EPOCHS[0], u, f"p{u}") for u in range(100, 200)])]))
    for call, pushed in (
        (f"get('123', '{EPOCHS[0]}')", f"EqualTo(userid_ts,321-{EPOCHS[0]})"),
        ("user('123')", "StringStartsWith(userid_ts,321-)"),
        (f"range('123', {EPOCHS[0]}, {EPOCHS[0] + 1})", "GreaterThanOrEqual(userid_ts,321-"),
    ):
        found = spark.sql(f"SELECT * FROM {made.table}_{call}")
        assert [r["payload"] for r in found.collect()] == ["p123"]
        plan = plan_of(found)
        filters = plan[plan.index("PartitionFilters: [") + 19 :]
        assert filters.startswith("isnotnull(region") and pushed in plan and "InMemoryFileIndex(1 paths)" in plan
    users = spark.createDataFrame([("123",), ("150",), ("999",)], "u string")
    users.createOrReplaceTempView("asked_users")
    assert spark.sql(f"SELECT payload FROM asked_users, LATERAL {made.table}_user(u)").count() == 2
    with pytest.raises(Exception, match="same number of digits"):
        spark.sql(f"SELECT * FROM {made.table}_range('123', 999, 1000)").collect()


def test_point_reads_skip_row_groups_by_bloom_filter(spark, inbox, settings, tmp_path):
    import pyarrow.parquet as pq

    made = settings(regions=1)
    LoadJob(spark, made).load(inbox.ready([inbox(EPOCHS[0], [line(EPOCHS[0], u, "p") for u in range(2000)])]))
    files = list((tmp_path / made.root.rsplit("/", 1)[1] / "data").glob("*/*/*.parquet"))
    text = files[0].read_bytes()
    plain = tmp_path / "plain"
    spark.read.parquet(str(files[0])).coalesce(1).write.option("compression", "gzip").parquet(str(plain))
    assert pq.ParquetFile(files[0]).metadata.num_rows == 2000
    assert len(text) > 100_000 + next(plain.glob("*.parquet")).stat().st_size  # the filter's bits


# --- merged buckets --------------------------------------------------------------------


def test_merged_buckets_serve_the_same(spark, inbox, settings):
    made = settings(compact_units=3, split_every=0)
    plain = settings(compact_units=0, split_every=0)
    jobs = [LoadJob(spark, m, clock=lambda now=itertools.count(10**9, 10): next(now)) for m in (made, plain)]
    for k, e in enumerate(EPOCHS[:11]):
        # the same keys again and again, so that versions meet inside units and between them
        entry = inbox(e, [line(1500000000 + j, u, f"{k}-{j}") for j in range(3) for u in (12, 345, 100 + k)])
        for job in jobs:
            job.load(inbox.ready([entry]))
    jobs[0].compact()
    as_of = F.timestamp_seconds(F.lit(10**9 + 100_000))
    got = [sorted(tuple(r) for r in table.serving(spark, m, as_of).collect()) for m in (made, plain)]
    assert got[0] == got[1] and len(got[0]) == 3 * 13
    units = compaction.stored_units(spark, made)
    assert len(units) <= 6 and min(units) < 0 and len(compaction.stored_units(spark, plain)) == 11
    regions = {r["region"]: r["n"] for r in spark.table(made.table).where("bucket_ts < 0").groupBy("region").agg(F.count_distinct("_metadata.file_path", "bucket_ts").alias("n")).collect()}
    assert set(regions.values()) <= set(range(1, len(units) + 1))
    assert spark.table(made.table).where(F.col("bucket_ts") == units[0]).groupBy("userid_ts").count().where("count > 1").count() == 0


@pytest.mark.parametrize("step", ["publish", "append", "drop_buckets"])
def test_a_merge_that_stops_half_way_loses_nothing(spark, inbox, settings, monkeypatch, step):
    made = settings(compact_units=0, split_every=0)
    job = LoadJob(spark, made)
    for k, e in enumerate(EPOCHS[:4]):
        job.load(inbox.ready([inbox(e, [line(e, 12, f"a{k}"), line(1500000000, 345, f"b{k}")])]))
    want = served(spark, made)
    made.compact_units = 3

    def fail(*_args, **_more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "append":
            patch.setattr(DeltaTable, "append", fail)
        else:
            kept = getattr(table, step)
            calls = itertools.count()
            # the first call of drop_buckets is that of ``finish``
            patch.setattr(table, step, fail if step == "publish" else lambda *a: kept(*a) if next(calls) == 0 else fail())
        with pytest.raises(RuntimeError, match="lost"):
            job.compact()
    assert served(spark, made) == want
    # a merge that was noted already only has its old units removed
    assert bool(job.compact()) == (step != "drop_buckets")
    assert served(spark, made) == want
    assert len(compaction.stored_units(spark, made)) == 2 and len([u for u in compaction.stored_units(spark, made) if u < 0]) == 1


def test_merged_buckets_expire_with_their_youngest(spark, inbox, settings):
    made, now = settings(compact_units=2, split_every=0, ttl_seconds=1000), [10**9]
    job = LoadJob(spark, made, clock=lambda: now[0])
    for e in EPOCHS[:2]:
        job.load(inbox.ready([inbox(e, [line(e, 12, "a")])]))
        now[0] += 600
    assert compaction.stored_units(spark, made) == [-1]
    at = lambda s: F.timestamp_seconds(F.lit(10**9 + s))
    done = ledger.read_ledger(spark, made.ledger_path)
    assert table.drop_expired(spark, made, done, at(1500)) == [] and table.serving(spark, made, at(1500)).count() == 1
    assert table.drop_expired(spark, made, done, at(1601)) == [-1]
    assert compaction.stored_units(spark, made) == [] and table.drop_expired(spark, made, done, at(1602)) == []


# --- buckets that can't be loaded ------------------------------------------------------


def test_a_bad_bucket_does_not_stop_the_others(spark, inbox, settings):
    made, now = settings(buckets_per_load=3, split_every=0), [10**9]
    good = [inbox(e, [line(e, 12, "a")]) for e in EPOCHS[1:4]]
    bad = (EPOCHS[0], str(inbox(EPOCHS[0], [])[1]) + "/")
    missing = (EPOCHS[0], bad[1].replace("/in/", "/gone/"))
    job = LoadJob(spark, made, clock=lambda: now[0])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run(lambda: inbox.ready([missing, *good]))
    assert sorted(r["bucket_ts"] for r in ledger.read_ledger(spark, made.ledger_path).collect()) == EPOCHS[1:4]
    kept = Failures(spark, made.failures_path).read()[str(EPOCHS[0])]
    assert kept["failures"] == 2 and kept["until"] > now[0] and "PATH_NOT_FOUND" in kept["error"]
    assert LoadJob(spark, made, clock=lambda: now[0]).run(lambda: inbox.ready([missing, *good])) == []
    now[0] += 10_000
    (inbox(EPOCHS[0], [line(EPOCHS[0], 7, "late")]))
    Failures(spark, made.failures_path).note(EPOCHS[0], bad[1].rstrip("/"), 2, now[0], "")
    assert [r.buckets for r in job.run(lambda: inbox.ready(good))] == [1]  # due again, though the list doesn't hold it any more
    assert Failures(spark, made.failures_path).read() == {}


def test_subfolders_like_partitions_beside_flat_buckets(spark, inbox, settings, tmp_path):
    made = settings(buckets_per_load=2)
    entries = [inbox(e, [line(e, 12, "a")]) for e in EPOCHS[:2]]
    nested = tmp_path / "in" / f"ts={EPOCHS[0]}" / "part=0"
    nested.mkdir()
    (nested / "y.txt").write_text(line(EPOCHS[0], 34, "b") + "\n")
    assert [r.buckets for r in LoadJob(spark, made).run(lambda: inbox.ready(entries))] == [2]
    assert sorted(r["userid_ts"] for r in spark.table(made.table).collect()) == sorted([f"21-{EPOCHS[0]}", f"43-{EPOCHS[0]}", f"21-{EPOCHS[1]}"])


# --- expiry, archive, locations ----------------------------------------------------------


def test_expired_buckets_are_not_opened(spark, inbox, settings):
    made, now = settings(ttl_seconds=1000), [10**9]
    job = LoadJob(spark, made, clock=lambda: now[0])
    for e in EPOCHS[:3]:
        job.load(inbox.ready([inbox(e, [line(e, 12, "a")])]))
        now[0] += 600
    as_of = F.timestamp_seconds(F.lit(10**9 + 1601))
    done = ledger.read_ledger(spark, made.ledger_path)
    pruned = table.serving(spark, made, as_of, done)
    assert sorted(tuple(r) for r in pruned.collect()) == sorted(tuple(r) for r in table.serving(spark, made, as_of).collect())
    assert pruned.count() == 1
    plan = plan_of(pruned)
    assert "dynamicpruning" in plan and "LeftSemi" in plan


def test_handled_entries_move_to_the_archive(spark, inbox, settings, tmp_path):
    made = settings(buckets_per_load=1)
    listing, checkpoint, archive = (str(tmp_path / n) for n in ("ready", "offsets", "archive"))
    manifest.announce(inbox.ready([inbox(e, [line(e, 12, "a")]) for e in EPOCHS[:3]]), listing)
    start_load_stream(LoadJob(spark, made), listing, checkpoint, archive=archive).awaitTermination()
    late = inbox(EPOCHS[0] - 1800, [line(EPOCHS[0], 34, "late")])
    manifest.announce(inbox.ready([late]), listing)
    start_load_stream(LoadJob(spark, made), listing, checkpoint, archive=archive).awaitTermination()
    done = sorted(r["bucket_ts"] for r in ledger.read_ledger(spark, made.ledger_path).collect())
    assert done == [EPOCHS[0] - 1800, *EPOCHS[:3]]
    assert len(list(tmp_path.glob("archive/**/*.txt"))) >= 2
    assert len(list((tmp_path / "ready").glob("*/*.txt"))) <= 2


def test_location_as_of(spark):
    rows = spark.createDataFrame([(1, "u", 5), (2, "u", 10), (3, "u", 19), (4, "u", 25), (5, "v", 15), (6, "w", 15), (7, None, 15)], "i int, user string, at bigint")
    dated = [("u", "a", 10), ("u", "b", 20), ("v", "c", 10), ("w", "d", 20), ("u", "a0", 10)]
    snapshots = spark.createDataFrame(dated, "user string, location string, valid_from bigint")
    found = enrich.with_location_as_of(rows, snapshots, F.col("at"), on=["user"])
    assert found.columns == ["i", "user", "at", "location_history"]
    assert {r["i"]: r["location_history"] for r in found.collect()} == {1: None, 2: "a0", 3: "a0", 4: "b", 5: "c", 6: None, 7: None}


def test_snapshots_keep_each_reading(spark, tmp_path):
    reads = []

    def read():
        reads.append(1)
        return spark.createDataFrame([("u", f"p{len(reads)}")], "user string, location string")

    for folder in (str(tmp_path / "kept"), None):
        reads.clear()
        dimension = enrich.RefreshedDimension(read, 1, 1000, folder)
        assert dimension.refresh(1000 + 3601) and dimension.refresh(1000 + 7300)
        assert sorted(tuple(r) for r in dimension.snapshots().collect()) == [("u", "p1", 1000), ("u", "p2", 4601), ("u", "p3", 8300)]


def test_location_table_of_the_settings():
    names = {
        "outputTable": "t", "dbType": "oracle", "pgConnString": "jdbc:postgresql://db/n", "oracleConnString": "jdbc:oracle:thin:@//db/n",
        "dbUser": "u", "dbPass": "p", "dbLocationTable": "places",
    }
    made = LoadSettings.from_mapping(names, "/r")
    assert "'p'" not in repr(made)
    session = mock.Mock()
    location_of_settings(session, made)
    properties = {"user": "u", "password": "p", "driver": "oracle.jdbc.OracleDriver"}
    session.read.jdbc.assert_called_once_with("jdbc:oracle:thin:@//db/n", "places", properties=properties)
    made.db_partition_column, made.db_connections = "mcc", 8
    session = mock.Mock()
    session.read.jdbc.return_value.first.return_value = (200, 750)
    location_of_settings(session, made)
    assert session.read.jdbc.call_args_list[0].args[1] == "(SELECT min(mcc) AS low, max(mcc) AS high FROM places) ends"
    assert session.read.jdbc.call_args.kwargs == {"column": "mcc", "lowerBound": 200, "upperBound": 751, "numPartitions": 8, "properties": properties}
    session.read.jdbc.return_value.first.return_value = (None, None)
    location_of_settings(session, made)
    assert session.read.jdbc.call_args.kwargs == {"properties": properties}
    made.oracle_url = None
    with pytest.raises(ValueError, match="connection string"):
        location_of_settings(session, made)
