"""The serving table: create, publish buckets, retention, view and keyed reads.

The table is a catalog table, so a read asks the catalog for the partitions it needs
and does not list the folders of all buckets. It is partitioned by (bucket_ts, region);
each file is sorted by ``userid_ts`` and has a Bloom filter of it. Negative bucket numbers are
merged buckets (see ``compaction``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fields import USER_KEY_SEPARATOR
from tidemark.functions.regions import KEY_CEILING, split_key_list
from tidemark.operators.deltas import DeltaTable
from tidemark.operators.layout import by_region
from tidemark.operators.region_set import REGION_SCHEMA, RegionSet
from tidemark.settings import LoadSettings
from tidemark.shared import delete_path, many_folders, path_exists, session_setting

TABLE_COLUMNS = (
    "userid_ts string, payload string, location_history string, loaded_at timestamp, "
    "bucket_ts bigint, region int"
)
COLUMN_ORDER = ["userid_ts", "payload", "location_history", "loaded_at", "bucket_ts", "region"]
TTL_PROPERTY = "tidemark.ttl_seconds"
BLOOM_KEYS = 1_000_000
"""Keys of a row group that its Bloom filter is sized for (at most a megabyte of it)."""
MERGE_SCHEMA = "bucket_ts bigint, unit bigint, tier int"
EXPIRY_PORTION = 200
"""Expired buckets that one call frees at most; the next call goes on."""
NEWEST = ["loaded_at", "bucket_ts", "payload"]
"""What makes one write of a key newer than another; the payload only breaks ties."""


def create_table(spark: SparkSession, settings: LoadSettings) -> list[str]:
    """Create the pre-split table if it is absent and return the start keys of its live regions.

    The regions and the time to live of an existing table stay what they were, whatever the settings say.
    """
    if not path_exists(spark, settings.bounds_path):
        keys = split_key_list(spark, settings.regions)
        regions_table(spark, settings).append([(i, key, None) for i, key in enumerate(keys, start=1)])
    known = spark.catalog.tableExists(settings.table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {settings.table} ({TABLE_COLUMNS}) USING parquet "
        f"OPTIONS (compression '{settings.compression}', 'parquet.bloom.filter.enabled#userid_ts' 'true', "
        f"'parquet.bloom.filter.expected.ndv#userid_ts' '{BLOOM_KEYS}') "
        f"PARTITIONED BY (bucket_ts, region) LOCATION '{settings.data_path}' "
        f"TBLPROPERTIES ('{TTL_PROPERTY}' = '{settings.ttl_seconds}')"
    )
    if not known and path_exists(spark, settings.data_path):
        spark.sql(f"MSCK REPAIR TABLE {settings.table}")
    return table_regions(spark, settings).bounds


def regions_table(spark: SparkSession, settings: LoadSettings) -> DeltaTable:
    return DeltaTable(spark, settings.bounds_path, REGION_SCHEMA)


def table_regions(spark: SparkSession, settings: LoadSettings) -> RegionSet:
    """All regions the table ever had: a number, a short text and a parent for each."""
    return RegionSet(sorted(set(regions_table(spark, settings).rows()), key=lambda r: r[0]))


def table_ttl(spark: SparkSession, settings: LoadSettings) -> int:
    """The table's time to live in seconds, asked of the catalog alone."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {settings.table}").collect()}
    return int(found.get(TTL_PROPERTY, settings.ttl_seconds))


def publish(rows: DataFrame, settings: LoadSettings) -> None:
    """Write whole buckets. Spark stages the files and publishes them on commit, and
    only the partitions that occur in ``rows`` are replaced. Load times are written in
    the form that has statistics, so that reads skip what has expired."""
    spark = rows.sparkSession
    ordered = by_region(rows.select(*COLUMN_ORDER), "bucket_ts")
    dynamic = session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")
    micros = session_setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    with dynamic, micros, many_folders(spark):
        ordered.write.mode("overwrite").insertInto(settings.table)


def drop_buckets(spark: SparkSession, settings: LoadSettings, buckets: Iterable[int]) -> None:
    """Remove all regions of the named buckets from the catalog and from storage. A folder goes last, so without one there
    is nothing to ask the catalog for."""
    for bucket in buckets:
        folder = f"{settings.data_path}/bucket_ts={bucket}"
        if not path_exists(spark, folder):
            continue
        parts = spark.sql(f"SHOW PARTITIONS {settings.table} PARTITION (bucket_ts={bucket})")
        specs = [
            "PARTITION (" + row["partition"].replace("/", ", ") + ")" for row in parts.collect()
        ]
        if specs:
            spark.sql(f"ALTER TABLE {settings.table} DROP IF EXISTS {', '.join(specs)}")
        delete_path(spark, folder)


# --- reads -----------------------------------------------------------------------


def is_visible(loaded_at: Column, ttl_seconds: int, as_of: Column | None = None) -> Column:
    """Whether a row's time to live, counted from its load, has not run out."""
    now = F.current_timestamp() if as_of is None else as_of
    return loaded_at >= now - F.expr(f"INTERVAL {int(ttl_seconds)} SECOND")


def keep_last(
    rows: DataFrame, keys: Sequence[str], newest: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per key: the newest. The grouped maximum reduces each key map-side, so
    a key with very many versions shuffles one row per map task."""
    columns = [*newest, *[v for v in values if v not in newest]]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def visible_versions(
    spark: SparkSession, settings: LoadSettings, as_of: Column | None = None
) -> DataFrame:
    """All stored versions that have not expired."""
    rows = spark.table(settings.table)
    return rows.where(is_visible(F.col("loaded_at"), table_ttl(spark, settings), as_of))


def _served(versions: DataFrame) -> DataFrame:
    # not by region as well: a key's versions from before a split lie in another region
    return keep_last(versions, ["userid_ts"], NEWEST, ["payload", "location_history"])


def serving(
    spark: SparkSession, settings: LoadSettings, as_of: Column | None = None, ledger: DataFrame | None = None
) -> DataFrame:
    """The view's rows: last value per key within its time to live. With the ``ledger`` expired buckets aren't even opened."""
    rows = visible_versions(spark, settings, as_of)
    return _served(rows if ledger is None else in_live_buckets(rows, settings, ledger, as_of))


def in_live_buckets(rows: DataFrame, settings: LoadSettings, ledger: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows of buckets that hold something not expired, by dynamic partition pruning: the join with the buckets' numbers, as many
    as fit in the time to live, goes into the scan's partition filter."""
    spark = rows.sparkSession
    units = with_unit(ledger.select("bucket_ts", "loaded_at"), merges_table(spark, settings).read())
    ages = units.groupBy(F.col("unit").alias("bucket_ts")).agg(F.max("loaded_at").alias("loaded_at"))
    live = ages.where(is_visible(F.col("loaded_at"), table_ttl(spark, settings), as_of)).select("bucket_ts")
    return rows.join(F.broadcast(live), "bucket_ts", "left_semi")


def create_view(spark: SparkSession, settings: LoadSettings, name: str) -> None:
    """Create the SQL view; ``settings.view_sql`` replaces its text."""
    spark.sql(settings.view_sql or f"CREATE OR REPLACE VIEW {name} AS {_served_sql(settings, table_ttl(spark, settings))}")


def _served_sql(settings: LoadSettings, ttl_seconds: int, condition: str = "true") -> str:
    newest = ", ".join([*NEWEST, "location_history"])
    return f"""
        SELECT userid_ts, last.payload AS payload, last.location_history AS location_history
        FROM (SELECT userid_ts, max(struct({newest})) AS last
              FROM {settings.table}
              WHERE loaded_at >= current_timestamp() - INTERVAL {ttl_seconds} SECOND AND ({condition})
              GROUP BY userid_ts)"""


def create_functions(spark: SparkSession, settings: LoadSettings, regions: RegionSet | None = None) -> None:
    """SQL table functions that read by key: ``<table>_get(user_id, ts)``, ``<table>_user(user_id)`` and
    ``<table>_range(user_id, range_start, range_end)`` (half-open, epochs of as many digits).

    They work out the regions from the key, so that a call opens the partitions of those only, where the view has to open all.
    They are persisted in the catalog and written anew when regions split; an older text would miss the children.
    """
    regions = regions or table_regions(spark, settings)
    ttl = table_ttl(spark, settings)
    prefix = f"concat(reverse(user_id), '{USER_KEY_SEPARATOR}')"
    ceiling = f"cast(X'{KEY_CEILING.encode().hex()}' as string)"
    start, end = "cast(range_start as string)", "cast(range_end as string)"
    digits = f"if(length({start}) = length({end}), true, cast(raise_error('range_start and range_end must have the same number of digits') as boolean))"
    within = f"userid_ts >= concat({prefix}, {start}) AND userid_ts < concat({prefix}, {end}) AND length(userid_ts) = length({prefix}) + length({start})"
    reads = {
        "get(user_id STRING, ts STRING)": (f"userid_ts = concat({prefix}, ts)", regions.paths_sql(f"concat({prefix}, ts)")),
        "user(user_id STRING)": (f"startswith(userid_ts, {prefix})", regions.range_sql(prefix, f"concat({prefix}, {ceiling})")),
        "range(user_id STRING, range_start BIGINT, range_end BIGINT)": (f"{within} AND {digits}", regions.range_sql(f"concat({prefix}, {start})", f"concat({prefix}, {end})")),
    }
    for head, (condition, numbers) in reads.items():
        body = _served_sql(settings, ttl, f"{condition} AND array_contains({numbers}, region)")
        spark.sql(f"CREATE OR REPLACE FUNCTION {settings.table}_{head} RETURNS TABLE(userid_ts STRING, payload STRING, location_history STRING) RETURN {body}")


def point_get(
    spark: SparkSession,
    settings: LoadSettings,
    user_id: object,
    ts: object,
    as_of: Column | None = None,
) -> DataFrame:
    """The value of one user at one time: one region, one key."""
    key = f"{_prefix(user_id)}{ts}"
    rows = _in_regions(visible_versions(spark, settings, as_of), settings, key, key)
    return _served(rows.where(F.col("userid_ts") == key))


def user_scan(
    spark: SparkSession, settings: LoadSettings, user_id: object, as_of: Column | None = None
) -> DataFrame:
    """All rows of one user; the separator in the prefix keeps longer ids out."""
    prefix = _prefix(user_id)
    rows = _in_regions(visible_versions(spark, settings, as_of), settings, prefix, prefix + KEY_CEILING)
    return _served(rows.where(F.col("userid_ts").startswith(prefix)))


def user_time_range(
    spark: SparkSession,
    settings: LoadSettings,
    user_id: object,
    start: int,
    end: int,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows of one user with ``start <= ts < end``. Keys compare as text, so both
    epochs need the same number of digits (true from 2001 to 2286)."""
    if len(str(start)) != len(str(end)):
        raise ValueError("start and end must have the same number of digits")
    prefix = _prefix(user_id)
    rows = _in_regions(visible_versions(spark, settings, as_of), settings, f"{prefix}{start}", f"{prefix}{end}")
    key = F.col("userid_ts")
    same_digits = F.length(key) == len(prefix) + len(str(start))
    return _served(rows.where((key >= f"{prefix}{start}") & (key < f"{prefix}{end}") & same_digits))


def _prefix(user_id: object) -> str:
    return str(user_id)[::-1] + USER_KEY_SEPARATOR


def _in_regions(rows: DataFrame, settings: LoadSettings, low: str, high: str) -> DataFrame:
    return rows.where(F.col("region").isin(table_regions(rows.sparkSession, settings).holding(low, high)))


# --- retention ---------------------------------------------------------------------


def expired_buckets(ledger: DataFrame, ttl_seconds: int, as_of: Column | None = None) -> DataFrame:
    """Buckets whose load is older than the time to live. A load writes a bucket as a
    whole, so the ledger knows the age of every row without reading one."""
    return ledger.where(~is_visible(F.col("loaded_at"), ttl_seconds, as_of))


def merges_table(spark: SparkSession, settings: LoadSettings) -> DeltaTable:
    """Which merged bucket holds a bucket's rows, one row for each bucket of each merge; the newest unit (the least number) counts."""
    newest = lambda rows: rows.groupBy("bucket_ts").agg(F.min(F.struct("unit", "tier")).alias("u")).select("bucket_ts", "u.unit", "u.tier")
    return DeltaTable(spark, settings.merges_path, MERGE_SCHEMA, newest)


def with_unit(ledger: DataFrame, merges: DataFrame) -> DataFrame:
    """Ledger rows with ``unit``, the bucket number their rows are stored under, and its ``tier``."""
    newest = merges.groupBy("bucket_ts").agg(F.min(F.struct("unit", "tier")).alias("_unit"))
    joined = ledger.join(newest, "bucket_ts", "left")
    return joined.select(*ledger.columns, F.coalesce("_unit.unit", "bucket_ts").alias("unit"), F.coalesce("_unit.tier", F.lit(0)).alias("tier"))


def drop_expired(
    spark: SparkSession, settings: LoadSettings, ledger: DataFrame, as_of: Column | None = None
) -> list[int]:
    """Free the storage of expired buckets, at most ``EXPIRY_PORTION`` of them; their ledger rows stay, so that they are
    not loaded again. A merged bucket goes when all buckets in it have expired.

    Buckets freed are noted below the table's root after they are gone, so each call asks for
    what has expired since the one before, and a call that stops in between is repeated.
    """
    units = with_unit(ledger.select("bucket_ts", "loaded_at"), merges_table(spark, settings).read())
    ages = units.groupBy(F.col("unit").alias("bucket_ts")).agg(F.max("loaded_at").alias("loaded_at"))
    expired = expired_buckets(ages, table_ttl(spark, settings), as_of).select("bucket_ts")
    noted = DeltaTable(spark, settings.expired_path, "bucket_ts bigint", lambda rows: rows.distinct())
    left = expired.join(noted.read(), "bucket_ts", "left_anti").orderBy("bucket_ts").limit(EXPIRY_PORTION)
    names = [r["bucket_ts"] for r in left.collect()]
    if names:
        drop_buckets(spark, settings, names)
        noted.append([(n,) for n in names])
        noted.fold()
    return names
