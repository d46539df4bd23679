import random
from bisect import bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.regions import region_interval, region_of, region_of_key, split_key_list, split_keys
from tidemark.operators.layout import live_region_bounds


def brute_force_keys(n):
    digits = len(str(n - 1)) + 1 if n > 1 else 1
    digits -= n % 10 == 0
    shares = [float(np.float32(np.float32(i) / np.float32(n))) for i in range(1, n)]
    return [f"{int(np.floor(share * 10**digits + 0.5)):0{digits}d}" for share in shares]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 10, 16, 20, 100, 120, 1000, 1024])
def test_split_keys(spark, n):
    assert split_key_list(spark, n) == (brute_force_keys(n) if n > 1 else [])


def test_known_split_keys(spark):
    assert split_key_list(spark, 10) == list("123456789")
    assert split_key_list(spark, 16)[:3] == ["063", "125", "188"]
    assert split_key_list(spark, 100) == [f"{i:02d}" for i in range(1, 100)]


def test_split_keys_per_row(spark):
    rows = spark.range(1, 60).select("id", split_keys(F.col("id")).alias("k")).collect()
    assert all(r["k"] == (brute_force_keys(r["id"]) if r["id"] > 1 else []) for r in rows)


def test_known_regions(spark):
    keys = ["54321-1", "00-1", "01", "8-1", "99999-1", "-1", "a-1"]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    found = frame.select("k", region_of("k", split_key_list(spark, 100)).alias("r")).collect()
    assert {r["k"]: r["r"] for r in found} == dict(zip(keys, [54, 0, 1, 79, 99, 0, 99]))


@pytest.mark.parametrize("count", [0, 1, 2, 9, 126, 127, 128, 129, 254, 255, 381, 1000])
def test_lookup_equals_search(spark, count):
    rng = random.Random(count)
    alphabet = "0123456789-aZé'\\ €\U0001f600"
    text = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 5)))
    bounds = set()
    while len(bounds) < count:
        bounds.add(text())
    bounds = sorted(bounds)
    keys = list({text() for _ in range(400)} | set(bounds) | {""})
    frame = spark.createDataFrame([(k,) for k in keys], "`row key` string")
    found = frame.select(F.col("row key"), region_of("row key", bounds).alias("r")).collect()
    assert all(r["r"] == bisect_right(bounds, r["row key"]) for r in found)
    assert all(region_of_key(k, bounds) == bisect_right(bounds, k) for k in keys)


def test_unsorted_bounds_are_refused():
    for bounds in (["2", "1"], ["1", "1"]):
        with pytest.raises(ValueError):
            region_of("k", bounds)


def test_hundred_regions_stay_in_codegen(spark):
    keys = spark.range(10).select(F.col("id").cast("string").alias("k"))
    placed = keys.select(region_of("k", split_key_list(spark, 100)).alias("r"))
    assert "*(1) Project" in placed._jdf.queryExecution().executedPlan().toString()


def test_interval_covers_prefix(spark):
    bounds = split_key_list(spark, 100)
    assert region_interval("54321-", bounds) == (54, 54)
    assert region_interval("5", bounds) == (49, 59)
    assert region_interval("", bounds) == (0, 99)
    for prefix in ("8-", "99", "0", "a"):
        low, high = region_interval(prefix, bounds)
        assert all(low <= region_of_key(prefix + t, bounds) <= high for t in ("", "0", "9", "z", "\U0010ffff"))


def test_live_bounds(spark):
    rows = [("", False), ("30", False), ("10", False), ("10", False), ("20", True), ("10", True), (None, False)]
    regions = spark.createDataFrame(rows, "start_key string, is_split boolean")
    assert [tuple(r) for r in live_region_bounds(regions).orderBy("region").collect()] == [(1, "10"), (2, "30")]
