from unittest import mock

import pytest
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket_of_path, bucket_start, parse_bucket_path
from tidemark.sources import buckets, dimension, manifest


@pytest.fixture
def folder(spark, tmp_path):
    def write(root, epoch, lines):
        path = tmp_path / root / f"ts={epoch}"
        path.mkdir(parents=True)
        (path / "data.txt").write_text("".join(f"{line}\n" for line in lines))
        return str(path)

    return write


def test_scan_keeps_copies_and_epochs(spark, folder):
    paths = [folder("in", 1517805000, ["a", "a", ""]), folder("in", 1517806800, ["b"])]
    folder("in", 1517808600, ["not listed"])
    want = [("", 1517805000), ("a", 1517805000), ("a", 1517805000), ("b", 1517806800)]
    for given in (paths, ",".join(paths)):
        read = buckets.read_buckets(spark, given)
        assert sorted(tuple(r) for r in read.collect()) == want
        assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_scan_over_several_roots(spark, folder):
    paths = [folder("one", 1800, ["a"]), folder("two", 3600, ["b"])]
    assert sorted(tuple(r) for r in buckets.read_buckets(spark, paths).collect()) == [("a", 1800), ("b", 3600)]


@pytest.mark.parametrize("roots", [("one", "one"), ("one", "two")])
@pytest.mark.parametrize("file", ["part=0.txt", "sub/x.txt", "sub/part=0.txt"])
def test_names_within_a_bucket_do_not_matter(spark, tmp_path, roots, file):
    paths = []
    for root, epoch, line in zip(roots, (1800, 3600), "ab", strict=True):
        path = tmp_path / root / f"ts={epoch}" / file
        path.parent.mkdir(parents=True)
        path.write_text(f"{line}\n")
        paths.append(str(tmp_path / root / f"ts={epoch}"))
    got = sorted(tuple(r) for r in buckets.read_buckets(spark, paths).collect())
    assert got == [("a", 1800), ("b", 3600)]
    found = sorted(tuple(r) for r in buckets.discover_buckets(spark, paths).collect())
    assert found == [("a", 1800), ("b", 3600)]


def test_empty_list(spark):
    assert buckets.read_buckets(spark, []).count() == 0


def test_long_epoch(spark, folder):
    read = buckets.read_buckets(spark, [folder("in", 99_999_999_999, ["a"])])
    assert read.first()["bucket_ts"] == 99_999_999_999


@pytest.mark.parametrize("path", ["/test/1517805000", "/test/ts=abc", "/test/ts=", "ts=5"])
def test_other_layouts_are_refused(path):
    with pytest.raises(ValueError):
        parse_bucket_path(path)


def test_epoch_of_path(spark):
    frame = spark.createDataFrame([("/in/a=b/ts=1517805000",), ("/in/none",)], "path string")
    assert [r[0] for r in frame.select(bucket_of_path(F.col("path"))).collect()] == [1517805000, None]


def test_bucket_start(spark):
    frame = spark.createDataFrame([(1517805000,), (1517806799,), (1517806800,)], "s bigint")
    assert [r[0] for r in frame.select(bucket_start(F.col("s"))).collect()] == [1517805000, 1517805000, 1517806800]


def test_manifest_round_trip(spark, tmp_path):
    ready = spark.createDataFrame([(1800, "/in/ts=1800"), (3600, "/in/ts=3600")], "bucket_ts bigint, path string")
    manifest.announce(ready, str(tmp_path / "ready"))
    assert sorted(tuple(r) for r in manifest.read_ready(spark, str(tmp_path / "ready")).collect()) == [
        (1800, "/in/ts=1800"),
        (3600, "/in/ts=3600"),
    ]
    assert len(list((tmp_path / "ready").glob("*/*.txt"))) == 2


def test_location_is_read_over_jdbc():
    """No database here: this shows what the reader is asked for, not that it answers."""
    session = mock.Mock()
    dimension.read_location(session, "postgresql", "jdbc:postgresql://db/network", "places", "u", "p")
    session.read.jdbc.assert_called_once_with(
        "jdbc:postgresql://db/network",
        "places",
        properties={"user": "u", "password": "p", "driver": "org.postgresql.Driver"},
    )


def test_unknown_database_kind(spark):
    with pytest.raises(ValueError):
        dimension.read_location(spark, "sqlite", "jdbc:sqlite:x", "t", "u", "p")


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    lines = spark.range(0, 300_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
        F.when(F.col("id") % 3 == 0, 3600).otherwise(F.col("id") % 50 * 7200).alias("bucket_ts"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        buckets.write_buckets(lines, str(tmp_path / "in"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "in" / "ts=3600").glob("*.txt"))) > 1
    assert buckets.discover_buckets(spark, [str(tmp_path / "in")]).count() == 300_000
