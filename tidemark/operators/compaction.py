"""Merging stored buckets, so that the number of files stays bounded however many buckets were loaded.

Buckets are merged in tiers: as many units of one tier as the settings say become one unit of the next, in which each
key has its newest version only. A merged unit is a partition of its own, with a negative bucket number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality, table
from tidemark.operators.claims import held
from tidemark.operators.region_set import RegionSet
from tidemark.settings import LoadSettings
from tidemark.shared import file_names

LOCK_SECONDS = 6 * 3600


def stored_units(spark: SparkSession, settings: LoadSettings) -> list[int]:
    """Bucket numbers that have a folder, asked of the file system."""
    return sorted(int(n.split("=", 1)[1]) for n in file_names(spark, settings.data_path) if n.startswith("bucket_ts="))


def plan(ledger: DataFrame, merges: DataFrame, settings: LoadSettings, as_of: Column | None = None) -> tuple[list[int], int]:
    """Units to merge next and their tier: the oldest ones of the least tier that is full; none if no tier is.

    Whole loads only. Rows of one load have the same age, so which of them is newest is decided by bucket number; with all of
    them in one unit no comparison with rows outside needs that number.
    """
    visible = table.is_visible(F.max("loaded_at"), table.table_ttl(ledger.sparkSession, settings), as_of)
    units = table.with_unit(ledger, merges).groupBy("unit", "tier").agg(
        F.min("loaded_at").alias("first"), F.max("loaded_at").alias("last"), visible.alias("visible")
    )
    live = units.where("visible")
    full = live.groupBy("tier").count().where(F.col("count") >= settings.compact_units).agg(F.min("tier")).first()[0]
    if full is None:
        return [], 0
    own = live.where(F.col("tier") == full)
    # a bounded number of the oldest, and what shares its load time with the last of them
    edge = own.orderBy("last", "unit").limit(settings.compact_units).agg(F.max("last").alias("edge"))
    chosen = own.join(F.broadcast(edge), F.col("last") <= F.col("edge")).select("unit").collect()
    return sorted(r["unit"] for r in chosen), full


def finish(spark: SparkSession, settings: LoadSettings) -> list[int]:
    """Remove what a merge that stopped half-way left: merged rows that were never noted, and units whose rows lie in a noted one."""
    merges = table.merges_table(spark, settings)
    if not merges.files():
        noted, covered = set(), set()
    else:
        rows = merges.read()
        noted = {r["unit"] for r in rows.select("unit").distinct().collect()}
        stored = spark.createDataFrame([(n,) for n in stored_units(spark, settings)], "bucket_ts bigint")
        newest = rows.groupBy("bucket_ts").agg(F.min("unit").alias("unit"))
        covered = {r["bucket_ts"] for r in newest.join(stored, "bucket_ts", "left_semi").select("bucket_ts").collect()}
        current = {r["unit"] for r in newest.select("unit").distinct().collect()}
        covered |= noted - current
    left = [n for n in stored_units(spark, settings) if n in covered or (n < 0 and n not in noted)]
    table.drop_buckets(spark, settings, left)
    return left


def merge_units(spark: SparkSession, settings: LoadSettings, regions: RegionSet, units: list[int], tier: int, ledger: DataFrame) -> int:
    """Merge the units into a new one and return its number.

    Rows are published first, then the merge is noted, then the old units go. In between keys are stored twice, with the same values,
    which no read can tell; a stop at any point loses nothing, and ``finish`` clears what it left.
    """
    merges = table.merges_table(spark, settings)
    known = merges.read()
    unit = min(0, known.agg(F.min("unit")).first()[0] or 0) - 1
    rows = spark.table(settings.table).where(F.col("bucket_ts").isin(units))
    last = table.keep_last(rows, ["userid_ts"], table.NEWEST, ["payload", "location_history", "loaded_at"])
    placed = last.withColumn("bucket_ts", F.lit(unit).cast("bigint")).withColumn("region", regions.column("userid_ts"))
    placed, seen = quality.observed(placed, [F.count("*").alias("n_keys")])
    table.publish(placed, settings)
    stored = spark.table(settings.table).where(F.col("bucket_ts") == unit).count()
    if not stored or stored != seen.get["n_keys"]:
        # nothing to observe, or tasks counted twice after an executor was lost
        keys = rows.agg(F.count_distinct("userid_ts")).first()[0]
        if stored != keys:
            raise RuntimeError(f"{stored} rows are stored of {keys} keys in units {units}")
    inside = table.with_unit(ledger.select("bucket_ts"), known).where(F.col("unit").isin(units))
    merges.append(inside.select("bucket_ts", F.lit(unit).cast("bigint").alias("unit"), F.lit(tier + 1).alias("tier")))
    table.drop_buckets(spark, settings, units)
    merges.fold()
    return unit


def compact(spark: SparkSession, settings: LoadSettings, regions: RegionSet, ledger: DataFrame, as_of: Column | None = None) -> list[int]:
    """Merge until no tier is full; the numbers of the new units. One job at a time merges; others go on without."""
    made: list[int] = []
    if settings.compact_units < 2:
        return made
    with held(spark, settings.root, "_compaction", LOCK_SECONDS) as mine:
        while mine:
            finish(spark, settings)
            units, tier = plan(ledger, table.merges_table(spark, settings).read(), settings, as_of)
            if not units:
                break
            made.append(merge_units(spark, settings, regions, units, tier, ledger))
    return made
