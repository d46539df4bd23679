import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.layout import by_key_range, by_region
from tidemark.operators.ranking import with_position


@pytest.mark.parametrize("count", [0, 1, 5, 4000])
def test_total_order(spark, count):
    values = random.Random(1).sample(range(10**6), count)
    frame = spark.createDataFrame([(v, str(v)) for v in values], "v bigint, t string")
    got = {r["v"]: r["position"] for r in with_position(frame, ["v"]).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values), start=1)}
    by_text = {r["t"]: r["position"] for r in with_position(frame, ["t"]).collect()}
    assert by_text == {t: i for i, t in enumerate(sorted(map(str, values)), start=1)}


def test_within_groups_with_a_hot_one_and_copies(spark):
    rng = random.Random(2)
    rows = [(7, "same") for _ in range(2000)] + [(rng.randint(0, 20), str(rng.random())) for _ in range(4000)]
    rows += [(None, "a"), (None, "b")]
    frame = spark.createDataFrame(rows, "g int, k string").repartition(6).checkpoint()
    got = sorted(((r["g"] is not None, r["g"] or 0, r["k"], r["position"]) for r in with_position(frame, ["k"], ["g"], copies=True).collect()))
    want, seen = [], {}
    for g, k in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen[g] = seen.get(g, 0) + 1
        want.append((g is not None, g or 0, k, seen[g]))
    assert got == sorted(want)


def test_copies_of_one_row_are_spread(spark):
    frame = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("region"), F.lit("k").alias("userid_ts"))
    ranged = by_key_range(frame, "region", "userid_ts", parts=8, copies=True)
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 12_000


def test_hot_region_is_split_and_every_part_sorted(spark, tmp_path):
    frame = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("int").alias("region"),
        F.sha2(F.col("id").cast("string"), 256).alias("userid_ts"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        numbered = by_region(frame).withColumn("at", F.monotonically_increasing_id())
        numbered.write.parquet(str(tmp_path / "rows"))
    finally:
        spark.conf.set(key, before)
    stored = spark.read.parquet(str(tmp_path / "rows")).withColumn("part", F.shiftright("at", 33))
    assert stored.where("region = 7").select("part").distinct().count() > 3
    rows = stored.toPandas().sort_values("at")
    assert len(rows) == 400_000
    for _, group in rows.groupby("part"):
        pairs = list(zip(group["region"], group["userid_ts"]))
        assert pairs == sorted(pairs)
