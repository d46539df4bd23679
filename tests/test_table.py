import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators import table
from tidemark.settings import LoadSettings, codec_or_default, regions_or_default

DAY = 86_400
numbers = itertools.count()


def at(epoch):
    return F.timestamp_seconds(F.lit(epoch))


@pytest.fixture
def settings(tmp_path):
    return LoadSettings(table=f"serving_{next(numbers)}", root=str(tmp_path / "t"), regions=10, ttl_seconds=30 * DAY)


def rows(spark, *values, loaded=1_000_000):
    """(key, payload, bucket) with the region of the first digit."""
    frame = spark.createDataFrame(list(values), "userid_ts string, payload string, bucket_ts bigint")
    return frame.withColumns(
        {
            "location_history": F.lit(None).cast("string"),
            "loaded_at": at(loaded),
            "region": F.substring("userid_ts", 1, 1).cast("int"),
        }
    )


def served(frame):
    return {r["userid_ts"]: r["payload"] for r in frame.collect()}


def test_codec_fallback():
    assert [codec_or_default(n) for n in ("gz", "GZ", "snappy", "zstd", "none", "lzo", "x", "", None)] == [
        "gzip", "gzip", "snappy", "zstd", "none", "gzip", "gzip", "gzip", "gzip",
    ]


def test_region_count_fallback():
    assert [regions_or_default(v) for v in (7, "12", "x", "", None, 0, "-1")] == [7, 12, 100, 100, 100, 1, 1]


def test_settings_from_names():
    made = LoadSettings.from_mapping(
        {
            "executionMode": "datatype1",
            "numberOfBucketsToProcessInOneIteration": "5",
            "outputTable": "datatypeone",
            "hbaseNumberOfRegions": "100",
            "hbaseTableCompression": "GZ",
            "cfTTL": "2592000",
            "resolveLocation": "false",
            "locDataUpdateFreq": "24",
            "sqlCreateViewQuery": "",
            "zkHost": "ignored",
        },
        root="/data/",
    )
    assert (made.table, made.buckets_per_load, made.regions, made.compression) == ("datatypeone", 5, 100, "gzip")
    assert (made.ttl_seconds, made.resolve_location, made.view_sql, made.root) == (2_592_000, False, None, "/data")
    with pytest.raises(ValueError):
        LoadSettings(table="t", root="/r", mode="datatype3")
    with pytest.raises(ValueError):
        LoadSettings(table="t", root="/r", buckets_per_load=0)


def test_create_keeps_the_first_bounds(spark, settings):
    assert table.create_table(spark, settings) == list("123456789")
    settings.regions = 4
    assert table.create_table(spark, settings) == list("123456789")


def test_single_region(spark, settings):
    settings.regions = 1
    assert table.create_table(spark, settings) == []


def test_publish_replaces_only_its_buckets(spark, settings):
    table.create_table(spark, settings)
    table.publish(rows(spark, ("11-1", "a", 1800), ("21-1", "b", 1800), ("31-1", "c", 3600)), settings)
    table.publish(rows(spark, ("11-1", "A", 1800), ("21-1", "B", 1800)), settings)
    assert served(spark.table(settings.table)) == {"11-1": "A", "21-1": "B", "31-1": "c"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_dropped_bucket_leaves_nothing_behind(spark, settings):
    table.create_table(spark, settings)
    table.publish(rows(spark, ("11-1", "a", 1800), ("21-1", "b", 1800), ("31-1", "c", 3600)), settings)
    table.drop_buckets(spark, settings, [1800, 999])
    table.publish(rows(spark, ("11-1", "A", 1800)), settings)
    assert served(spark.table(settings.table)) == {"11-1": "A", "31-1": "c"}


def test_files_use_the_codec_and_are_sorted(spark, settings, tmp_path):
    table.create_table(spark, settings)
    table.publish(rows(spark, *[(f"{i}-1", "p", 1800) for i in range(100, 190)]), settings)
    files = list((tmp_path / "t" / "data").glob("bucket_ts=1800/region=1/*.gz.parquet"))
    assert len(files) == 1
    keys = [r["userid_ts"] for r in spark.read.parquet(str(files[0])).collect()]
    assert keys == sorted(keys) and len(keys) == 90


def test_table_is_found_again_without_a_catalog(spark, settings):
    table.create_table(spark, settings)
    table.publish(rows(spark, ("11-1", "a", 1800)), settings)
    spark.sql(f"DROP TABLE {settings.table}")
    table.create_table(spark, settings)
    assert served(spark.table(settings.table)) == {"11-1": "a"}


def test_newest_write_wins(spark, settings):
    table.create_table(spark, settings)
    table.publish(rows(spark, ("11-1", "new bucket", 3600), loaded=1_000_000), settings)
    table.publish(rows(spark, ("11-1", "late bucket", 1800), loaded=1_000_001), settings)
    table.publish(rows(spark, ("12-1", "x", 5400), ("12-1", "y", 5400)), settings)
    now = at(1_000_002)
    assert served(table.serving(spark, settings, now)) == {"11-1": "late bucket", "12-1": "y"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    versions = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t")
    )
    last = table.keep_last(versions, ["k"], ["t"], ["t"])
    assert last.where("k = 'hot'").first()["t"] == 99_999
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange") > plan.index("functions=[max")


def test_time_to_live(spark, settings):
    table.create_table(spark, settings)
    table.publish(rows(spark, ("11-1", "old", 1800), loaded=1_000_000), settings)
    table.publish(rows(spark, ("12-1", "young", 3600), loaded=1_000_001), settings)
    edge = 1_000_000 + 30 * DAY
    assert set(served(table.serving(spark, settings, at(edge)))) == {"11-1", "12-1"}
    assert set(served(table.serving(spark, settings, at(edge + 1)))) == {"12-1"}
    ledger = spark.createDataFrame([(1800, 1_000_000), (3600, 1_000_001)], "bucket_ts bigint, s bigint").select(
        "bucket_ts", F.timestamp_seconds("s").alias("loaded_at")
    )
    assert table.drop_expired(spark, settings, ledger, at(edge)) == []
    assert table.drop_expired(spark, settings, ledger, at(edge + 1)) == [1800]
    assert table.drop_expired(spark, settings, ledger, at(edge + 1)) == []
    assert served(spark.table(settings.table)) == {"12-1": "young"}


def test_view(spark, settings):
    table.create_table(spark, settings)
    now = int(datetime.datetime.now().timestamp())
    table.publish(rows(spark, ("11-1", "a", 1800), ("11-1", "b", 1800), loaded=now), settings)
    table.publish(rows(spark, ("12-1", "gone", 3600), loaded=now - 31 * DAY), settings)
    name = f"{settings.table}_view"
    table.create_view(spark, settings, name)
    table.create_view(spark, settings, name)
    assert spark.table(name).columns == ["userid_ts", "payload", "location_history"]
    assert [tuple(r) for r in spark.table(name).collect()] == [("11-1", "b", None)]
    settings.view_sql = f"CREATE VIEW {name}_own AS SELECT userid_ts FROM {settings.table}"
    table.create_view(spark, settings, f"{name}_own")
    assert spark.table(f"{name}_own").columns == ["userid_ts"]


@pytest.fixture
def filled(spark, settings):
    table.create_table(spark, settings)
    keys = [("21-1704000000", "a"), ("21-1704000100", "b"), ("21-1704000200", "c"), ("2-1704000000", "d"), ("211-1704000000", "e")]
    table.publish(rows(spark, *[(k, p, 1704000000 // 1800 * 1800) for k, p in keys], loaded=1704000000), settings)
    return settings


NOW = 1704000300


def test_point_get(spark, filled):
    assert served(table.point_get(spark, filled, 12, 1704000100, at(NOW))) == {"21-1704000100": "b"}
    assert served(table.point_get(spark, filled, 12, 1704000101, at(NOW))) == {}


def test_user_scan_keeps_longer_ids_out(spark, filled):
    assert set(served(table.user_scan(spark, filled, 12, at(NOW))).values()) == {"a", "b", "c"}
    assert set(served(table.user_scan(spark, filled, 2, at(NOW))).values()) == {"d"}


def test_user_time_range_is_half_open(spark, filled):
    got = table.user_time_range(spark, filled, 12, 1704000000, 1704000200, at(NOW))
    assert set(served(got).values()) == {"a", "b"}
    with pytest.raises(ValueError):
        table.user_time_range(spark, filled, 12, 999, 1704000200)


@pytest.mark.parametrize(
    "read,pushed",
    [
        (lambda s, t: table.point_get(s, t, 12, 1704000100, at(NOW)), "EqualTo(userid_ts,21-1704000100)"),
        (lambda s, t: table.user_scan(s, t, 12, at(NOW)), "StringStartsWith(userid_ts,21-)"),
        (lambda s, t: table.user_time_range(s, t, 12, 1704000000, 1704000200, at(NOW)), "LessThan(userid_ts,21-1704000200)"),
    ],
)
def test_reads_prune_and_push_down(spark, filled, read, pushed):
    plan = read(spark, filled)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan
    assert "PartitionFilters: [isnotnull(region" in plan
    assert "GreaterThanOrEqual(loaded_at" in plan


def test_view_predicate_reaches_the_scan(spark, filled):
    name = f"{filled.table}_view"
    table.create_view(spark, filled, name)
    plan = spark.sql(f"SELECT * FROM {name} WHERE userid_ts = '21-1704000100'")
    assert "EqualTo(userid_ts,21-1704000100)" in plan._jdf.queryExecution().executedPlan().toString()


def test_time_to_live_stays_with_the_table(spark, settings):
    table.create_table(spark, settings)
    now = int(datetime.datetime.now().timestamp())
    table.publish(rows(spark, ("11-1", "a", 1800), loaded=now - DAY), settings)
    settings.ttl_seconds = 1
    table.create_table(spark, settings)
    name = f"{settings.table}_view"
    table.create_view(spark, settings, name)
    assert served(spark.table(name)) == served(table.serving(spark, settings)) == {"11-1": "a"}
