"""Pipeline inputs derived from the given ``events``, ``customer`` and ``nation`` tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import BUCKET_SECONDS, bucket_start
from tidemark.operators import enrich, ledger
from tidemark.plans.load import LoadJob
from tidemark.settings import LoadSettings
from tidemark.shared import new_folder
from tidemark.sources import buckets as bucket_source
from tidemark.sources import manifest

DAY_SECONDS = 86_400
BUCKETS_PER_LOAD = 5
REGIONS = 100
TABLE_REGIONS = 10
READY_ROOT = "/in/ts="

LINE_SQL = r"""
    case event_id % 10
      when 0 then concat_ws('\t', s, u, event_type)
      when 1 then concat_ws('\t', s, u, event_type, props, e)
      when 2 then concat(concat_ws('\t', s, u, event_type, props), '\t\t')
      when 3 then concat_ws('\t', s, u, event_type, props, e, e)
      when 4 then concat_ws('\t', s, u, event_type, '', e)
      when 5 then concat(concat_ws('\t', s, u, event_type), '\t')
      when 6 then concat_ws('\t', s, u)
      else concat_ws('\t', s, u, event_type, props)
    end as value
"""

PAYLOAD_SQL = """
    case event_id % 12
      when 0 then '{bad'
      when 1 then ''
      when 2 then concat('{"header":{"icid":"c', e, '"}}')
      when 3 then concat('{"dimensions":{"mo":{"imsi":"', u, '"}}}')
      when 4 then '[1]'
      when 5 then cast(null as string)
      when 6 then '{"header":null}'
      when 7 then concat('{"header":{"icid":"c', e, '"}} junk')
      when 8 then concat('{"header":{"icid":"c', e, '"}}}')
      when 9 then concat('{"header":{"icid":"c', e, '"}} {"header":{"icid":"d"}}')
      when 10 then concat('{"x":1,"x":[2],"header":{"icid":"c', e, '"}}')
      else concat('{"header":{"icid":"c', e, '","start":', s,
                  '},"dimensions":{"mo":{"imsi":"', u, '"},"mt":{"imsi":""}}}')
    end as payload
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``sec``, their epoch second. The files hold timestamps without a zone,
    taken as UTC whatever the zone of the session."""
    frame = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint") * DAY_SECONDS
    return frame.withColumn("sec", day + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts"))


def _as_text(frame: DataFrame) -> DataFrame:
    return frame.selectExpr(
        "*", "cast(sec as string) as s", "cast(user_id as string) as u", "cast(event_id as string) as e"
    )


def lines(spark: SparkSession, sf_dir: str, width: int = BUCKET_SECONDS) -> DataFrame:
    """Delimited lines of every shape the filters tell apart."""
    texts = _as_text(events(spark, sf_dir))
    return texts.selectExpr("event_id", "sec", LINE_SQL).withColumn(
        "bucket_ts", bucket_start(F.col("sec"), width)
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads: whole, partial, malformed, empty and null."""
    texts = _as_text(events(spark, sf_dir))
    return texts.selectExpr("event_id", "sec", PAYLOAD_SQL).withColumn(
        "bucket_ts", bucket_start(F.col("sec"))
    )


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per half-hour bucket that has events."""
    found = events(spark, sf_dir).select(bucket_start(F.col("sec")).alias("bucket_ts")).distinct()
    return found.withColumn("path", F.concat(F.lit(READY_ROOT), F.col("bucket_ts").cast("string")))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of each day's first half: loaded already, the second half is waiting."""
    return ready(spark, sf_dir).where(F.col("bucket_ts") % DAY_SECONDS < DAY_SECONDS // 2)


def ready_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ready buckets with the iteration that loads them, counted from 1."""
    numbered = ledger.batches(ready(spark, sf_dir), BUCKETS_PER_LOAD)
    return numbered.select("bucket_ts", "path", (F.col("batch_id") + 1).alias("iteration"))


def load_log(spark: SparkSession, sf_dir: str, batches: DataFrame | None = None) -> DataFrame:
    """One load per iteration, starting when its last bucket is complete and taking one
    second per event."""
    sizes = (
        events(spark, sf_dir)
        .groupBy(bucket_start(F.col("sec")).alias("bucket_ts"))
        .agg(F.count("*").alias("n_events"))
    )
    batches = ready_batches(spark, sf_dir) if batches is None else batches
    by_load = batches.join(sizes, "bucket_ts").groupBy("iteration")
    return by_load.agg(
        (F.max("bucket_ts") + BUCKET_SECONDS).alias("started"),
        (F.max("bucket_ts") + BUCKET_SECONDS + F.sum("n_events")).alias("finished"),
        F.count("*").cast("int").alias("n_buckets"),
    )


# --- written inputs: once per application and table folder ---------------------------


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with two roots, ``a`` and ``b``, of bucket folders holding ``lines``, the days by
    turns. One folder a day: the tables have few events per half hour, and a folder with
    seven lines would measure file creation."""
    return _landing(spark, spark.sparkContext.applicationId, sf_dir)


@cache
def _landing(spark: SparkSession, _app: str, sf_dir: str) -> str:
    root = new_folder(spark, "landing")
    texts = lines(spark, sf_dir, DAY_SECONDS)
    for side in ("a", "b"):
        bucket_source.write_buckets(texts.where(_side() == side), f"{root}/{side}")
    return root


def _side() -> Column:
    return F.when(F.col("bucket_ts") % (2 * DAY_SECONDS) == 0, "a").otherwise("b")


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = bucket_start(F.col("sec"), DAY_SECONDS).alias("bucket_ts")
    return events(spark, sf_dir).select(day).distinct()


def folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready entries that point at the bucket folders of ``landing``."""
    root = landing(spark, sf_dir)
    path = F.concat(F.lit(f"{root}/"), _side(), F.lit("/ts="), F.col("bucket_ts").cast("string"))
    return days(spark, sf_dir).withColumn("path", path)


def new_settings(
    spark: SparkSession, label: str, buckets_per_load: int = BUCKETS_PER_LOAD, **more: object
) -> LoadSettings:
    root = new_folder(spark, label)
    return LoadSettings(
        table="tidemark_" + root.rsplit("/", 1)[1].replace("-", "_"),
        root=root,
        buckets_per_load=buckets_per_load,
        regions=TABLE_REGIONS,
        **{"split_every": 0, "compact_units": 0, **more},
    )


def loaded(spark: SparkSession, sf_dir: str) -> LoadSettings:
    """Settings of a table that holds all day buckets, loaded five at a time."""
    return _loaded(spark, spark.sparkContext.applicationId, sf_dir)


@cache
def _loaded(spark: SparkSession, _app: str, sf_dir: str) -> LoadSettings:
    settings = new_settings(spark, "batch")
    listing = new_folder(spark, "ready")
    manifest.announce(folders(spark, sf_dir), listing)
    LoadJob(spark, settings).run(lambda: manifest.read_ready(spark, listing))
    return settings


def merged(spark: SparkSession, sf_dir: str) -> LoadSettings:
    """Settings of a table that holds the same, loaded ten buckets at a time, its regions split after each load and its
    buckets merged by eights."""
    return _merged(spark, spark.sparkContext.applicationId, sf_dir)


@cache
def _merged(spark: SparkSession, _app: str, sf_dir: str) -> LoadSettings:
    settings = new_settings(spark, "merged", 10, split_every=1, compact_units=8)
    entries = folders(spark, sf_dir)
    LoadJob(spark, settings).run(lambda: entries)
    return settings


DATED_START = 1_706_745_600
DATED_STEP = 10 * DAY_SECONDS


def dated(spark: SparkSession, sf_dir: str) -> LoadSettings:
    """Settings of a table loaded ten buckets at a time, ten days apart from 1 February 2024 on, with locations that are read anew
    each time: the customer's nation with the number of the reading."""
    return _dated(spark, spark.sparkContext.applicationId, sf_dir)


@cache
def _dated(spark: SparkSession, _app: str, sf_dir: str) -> LoadSettings:
    settings = new_settings(spark, "dated", 10, resolve_location=True)
    entries, now, reads = folders(spark, sf_dir), [DATED_START], [0]

    def dimension() -> DataFrame:
        customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
        named = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        reads[0] += 1
        location = F.concat_ws("-", "n_name", F.lit(str(reads[0])))
        return named.select(F.col("c_custkey").cast("string").alias("user"), location.alias("location"))

    def locate(keyed: DataFrame, location: enrich.RefreshedDimension) -> DataFrame:
        user = F.reverse(F.substring_index("userid_ts", "-", 1)).alias("user")
        return enrich.with_location(keyed.select("*", user), location.frame, on=["user"], broadcast=location.broadcast).drop("user")

    job = LoadJob(spark, settings, dimension, locate, clock=lambda: now[0])
    while job.load(entries) is not None:
        now[0] += DATED_STEP
    return settings
