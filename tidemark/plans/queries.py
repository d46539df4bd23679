"""Every operator over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fields as X
from tidemark.functions import payload as J
from tidemark.functions import regions as R
from tidemark.functions.buckets import bucket_start
from tidemark.operators import enrich, layout, ledger, metrics, parse, quality, table
from tidemark.operators.ranking import with_position
from tidemark.plans import inputs
from tidemark.plans.load import LoadJob
from tidemark.shared import new_folder
from tidemark.sources import buckets as bucket_source
from tidemark.sources import manifest
from tidemark.streaming.load_stream import start_load_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.with_fields(inputs.lines(spark, sf_dir))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = parse.keep_datatype1(_records(spark, sf_dir))
    return parse.keyed_payloads(kept, carry=("event_id",))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = R.split_key_list(spark, inputs.REGIONS)
    return layout.with_region(_keyed(spark, sf_dir), bounds)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one load would place where: lines to keyed payloads, by region, sorted."""
    keyed = parse.parse_datatype1(inputs.lines(spark, sf_dir))
    placed = layout.with_region(keyed, R.split_key_list(spark, inputs.REGIONS))
    return layout.by_region(placed).select("region", "userid_ts", "payload")


# --- lines and records ----------------------------------------------------------------


@query
def split_fields(spark, sf_dir):
    f = F.col("fields")
    return _records(spark, sf_dir).select(
        "event_id", F.size(f).alias("n_fields"), F.concat_ws("|", f).alias("fields")
    )


@query
def filter_arity_4_5(spark, sf_dir):
    kept = parse.keep_datatype1(_records(spark, sf_dir))
    return kept.select("event_id", F.size("fields").alias("n_fields"))


@query
def filter_arity_2_4(spark, sf_dir):
    kept = parse.parse_datatype2(inputs.lines(spark, sf_dir), carry=("event_id",))
    return kept.select("event_id", F.size("fields").alias("n_fields"))


@query
def rowkey_build(spark, sf_dir):
    return _keyed(spark, sf_dir)


@query
def cell_encode(spark, sf_dir):
    encoded = parse.cells(_keyed(spark, sf_dir))
    return encoded.select(*[F.hex(c).alias(f"{c}_hex") for c in encoded.columns])


@query
def filter_key_length(spark, sf_dir):
    """Whole document texts as user ids: some make keys that are too long to store."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    key = X.row_key(F.col("text"), F.col("doc_id").cast("string"))
    keyed = documents.select("doc_id", key.alias("userid_ts"))
    return parse.keep_storable_keys(keyed).select(
        "doc_id", F.octet_length("userid_ts").cast("bigint").alias("key_bytes")
    )


# --- regions --------------------------------------------------------------------------


@query
def split_keys(spark, sf_dir):
    """Split keys for every region count that occurs as a part size."""
    counts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_size").distinct()
    keys = counts.select("p_size", F.posexplode(R.split_keys(F.col("p_size"))).alias("at", "split_key"))
    return keys.select(
        F.col("p_size").alias("regions"), (F.col("at") + 1).alias("region"), "split_key"
    )


@query
def region_bounds(spark, sf_dir):
    """Live bounds out of a region list with split parents, copies and an empty key."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    start_key = F.substring(F.reverse(F.col("c_custkey").cast("string")), 1, 2)
    regions = customer.select(
        F.when(F.col("c_nationkey") == 0, F.lit("")).otherwise(start_key).alias("start_key"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_split"),
    )
    return layout.live_region_bounds(regions)


@query
def region_lookup(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    keys = events.select(
        "event_id",
        X.row_key(F.col("user_id").cast("string"), F.col("sec").cast("string")).alias("userid_ts"),
    )
    return layout.with_region(keys, R.split_key_list(spark, inputs.REGIONS))


@query
def region_histogram(spark, sf_dir):
    return region_lookup(spark, sf_dir).groupBy("region").agg(F.count("*").alias("n_rows"))


@query
def range_layout(spark, sf_dir):
    """Each kept row with its place in the sorted key range of its region."""
    placed = _placed(spark, sf_dir).select("region", "userid_ts", "payload")
    return with_position(placed, ["userid_ts", "payload"], within=["region"], copies=True)


# --- buckets and ledger ---------------------------------------------------------------


@query
def multi_bucket_scan(spark, sf_dir):
    paths = [r["path"] for r in inputs.folders(spark, sf_dir).select("path").collect()]
    return bucket_source.read_buckets(spark, ",".join(paths)).select(
        "bucket_ts", F.col("value").alias("line")
    )


@query
def bucket_discovery(spark, sf_dir):
    found = bucket_source.discover_buckets(spark, [inputs.landing(spark, sf_dir)])
    return found.groupBy("bucket_ts").agg(F.count("*").alias("n_lines"))


@query
def ready_listing(spark, sf_dir):
    listing = new_folder(spark, "ready")
    days = inputs.days(spark, sf_dir)
    path = F.concat(F.lit(inputs.READY_ROOT), F.col("bucket_ts").cast("string"))
    manifest.announce(days.withColumn("path", path), listing)
    return manifest.read_ready(spark, listing)


@query
def ready_minus_processed(spark, sf_dir):
    return ledger.pending(inputs.ready(spark, sf_dir), inputs.processed(spark, sf_dir))


@query
def bucket_batches(spark, sf_dir):
    waiting = ready_minus_processed(spark, sf_dir)
    return ledger.batches(waiting, inputs.BUCKETS_PER_LOAD)


@query
def processed_ledger(spark, sf_dir):
    """A ledger that holds half the buckets, then is told about all of them twice."""
    path = new_folder(spark, "processed")
    loaded_at = F.timestamp_seconds("bucket_ts")

    def entries(frame, batch_id):
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        times = [loaded_at.alias("loaded_at"), loaded_at.alias("finished_at")]
        return frame.select("bucket_ts", "path", number, *times)

    ledger.mark_processed(entries(inputs.processed(spark, sf_dir), 1), path)
    for batch_id in (2, 3):
        ledger.mark_processed(entries(inputs.ready(spark, sf_dir), batch_id), path)
    return ledger.read_ledger(spark, path).select("bucket_ts", "path", "batch_id")


# --- payload getters ------------------------------------------------------------------


def _getter(spark, sf_dir, name):
    payloads = inputs.payloads(spark, sf_dir)
    return payloads.select("event_id", J.payload_fields(F.col("payload"), (name,))[name].alias(name))


@query
def json_icid(spark, sf_dir):
    return _getter(spark, sf_dir, "icid")


@query
def json_start(spark, sf_dir):
    return _getter(spark, sf_dir, "start")


@query
def json_mo_imsi(spark, sf_dir):
    return _getter(spark, sf_dir, "mo_imsi")


@query
def json_mt_imsi(spark, sf_dir):
    return _getter(spark, sf_dir, "mt_imsi")


@query
def filter_mo_present(spark, sf_dir):
    return parse.keep_present(json_mo_imsi(spark, sf_dir), "mo_imsi")


@query
def filter_mt_present(spark, sf_dir):
    return parse.keep_present(json_mt_imsi(spark, sf_dir), "mt_imsi")


@query
def filter_json_valid(spark, sf_dir):
    return parse.keep_valid_json(inputs.payloads(spark, sf_dir)).select("event_id", "payload")


# --- metrics --------------------------------------------------------------------------


@query
def quality_counters(spark, sf_dir):
    """Counters of all three filters per bucket, in one grouped pass each."""
    arity = quality.quality_counters(
        _records(spark, sf_dir), quality.arity_counts(X.DATATYPE1_ARITIES), "bucket_ts"
    )
    getters = J.payload_fields(F.col("payload"), ("mo_imsi", "mt_imsi"))
    imsis = inputs.payloads(spark, sf_dir).select("bucket_ts", getters.alias("g"))
    counts = quality.presence_counts("mo_imsi", "mo_imsi") + quality.presence_counts("mt_imsi", "mt_imsi")
    present = quality.quality_counters(imsis.select("bucket_ts", "g.*"), counts, "bucket_ts")
    return arity.join(present, "bucket_ts")


@query
def ledger_counts(spark, sf_dir):
    return metrics.ledger_counts(inputs.ready(spark, sf_dir), inputs.processed(spark, sf_dir))


@query
def buckets_ahead(spark, sf_dir):
    return metrics.buckets_ahead(inputs.ready(spark, sf_dir))


@query
def load_time(spark, sf_dir):
    return metrics.load_times(inputs.load_log(spark, sf_dir))


@query
def trailing_load_mean(spark, sf_dir):
    return metrics.trailing_load_mean(inputs.load_log(spark, sf_dir))


@query
def bucket_lag(spark, sf_dir):
    batches = inputs.ready_batches(spark, sf_dir)
    started = inputs.load_log(spark, sf_dir).select("iteration", "started")
    lag = metrics.bucket_lag(F.col("started"), F.col("bucket_ts"))
    return batches.join(started, "iteration").select("bucket_ts", *lag)


@query
def last_batch_summary(spark, sf_dir):
    return metrics.batch_summary(inputs.ready_batches(spark, sf_dir), "iteration")


@query
def metrics_latest(spark, sf_dir):
    """All values the loads of the log wrote, put into the sink and read from it after its files were merged."""
    batches = inputs.ready_batches(spark, sf_dir).checkpoint()
    log = inputs.load_log(spark, sf_dir, batches).checkpoint()
    ahead = metrics.buckets_ahead(batches.select("bucket_ts"))
    last = batches.groupBy("iteration").agg(F.max(F.struct("bucket_ts", "path")).alias("b"))
    started = F.timestamp_seconds("started").alias("updated_at")
    finished = F.timestamp_seconds("finished").alias("updated_at")
    before = (
        log.join(last, "iteration")
        .join(metrics.trailing_load_mean(log), "iteration")
        .join(ahead.withColumnRenamed("bucket_ts", "_last"), F.col("b.bucket_ts") == F.col("_last"))
        .select(
            started,
            F.col("ahead").alias(metrics.BUCKETS_AHEAD),
            F.col("mean_load_time").alias(metrics.MEAN_LOAD_TIME),
            F.col("b.path").alias(metrics.CURRENT_PATH),
            F.col("b.bucket_ts").alias(metrics.CURRENT_TS),
            *metrics.bucket_lag(F.col("started"), F.col("b.bucket_ts")),
        )
    )
    after = (
        log.join(metrics.batch_summary(batches, "iteration"), "iteration")
        .join(metrics.load_times(log), "iteration")
        .join(F.broadcast(batches.agg(F.count("*").alias("_ready"))), F.lit(True))
        .select(
            finished,
            F.col("_ready").alias(metrics.READY_COUNT),
            F.least(F.col("iteration") * inputs.BUCKETS_PER_LOAD, F.col("_ready")).alias(metrics.PROCESSED_COUNT),
            metrics.LAST_PATH,
            metrics.LAST_TS,
            F.col("load_time").alias(metrics.LAST_LOAD_TIME),
        )
    )
    week = bucket_start(F.col("started"), 7 * inputs.DAY_SECONDS)
    refreshes = log.groupBy(week.alias("week")).agg(F.min("started").alias("at"))
    refreshed = refreshes.select(F.timestamp_seconds("at").alias("updated_at"), F.col("at").alias(metrics.LOCATION_UPDATED))
    begun = log.agg(F.timestamp_seconds(F.min("started")).alias("updated_at"), F.lit("loader").alias(metrics.APPLICATION_ID))
    written = reduce(DataFrame.unionByName, map(_as_rows, (before, after, refreshed, begun))).where(F.col("value").isNotNull())
    path = new_folder(spark, "metrics")
    sink = metrics.metrics_table(spark, path)
    sink.append(written.select("name", "value", "updated_at"))
    sink.fold(least=0)
    return metrics.read_metrics(spark, path).select("name", "value", F.unix_seconds("updated_at").alias("updated_at"))


def _as_rows(wide):
    names = [c for c in wide.columns if c != "updated_at"]
    texts = wide.select("updated_at", *[F.col(c).cast("string").alias(c) for c in names])
    return texts.unpivot("updated_at", names, "name", "value")


# --- serving table --------------------------------------------------------------------


@query
def upsert_keep_last(spark, sf_dir):
    """One key per user and day, written again in each half hour with events."""
    events = inputs.events(spark, sf_dir)
    day = bucket_start(F.col("sec"), inputs.DAY_SECONDS).cast("string")
    versions = events.select(
        X.row_key(F.col("user_id").cast("string"), day).alias("userid_ts"),
        bucket_start(F.col("sec")).alias("bucket_ts"),
        F.col("props").alias("payload"),
    )
    return table.keep_last(versions, ["userid_ts"], ["bucket_ts", "payload"], ["bucket_ts", "payload"])


@query
def retention_ttl(spark, sf_dir):
    """Rows still visible on 2024-02-10 when each bucket is loaded at its own epoch."""
    bucket = bucket_start(F.col("sec")).alias("bucket_ts")
    rows = inputs.events(spark, sf_dir).select("event_id", bucket)
    as_of = F.timestamp_seconds(F.lit(1_707_523_200))
    return rows.where(table.is_visible(F.timestamp_seconds("bucket_ts"), 2_592_000, as_of))


@query
def bulk_load(spark, sf_dir):
    stored = spark.table(inputs.loaded(spark, sf_dir).table)
    return stored.select("bucket_ts", "region", "userid_ts", "payload")


@query
def serving_view(spark, sf_dir):
    return spark.table(f"{inputs.loaded(spark, sf_dir).table}_view")


def _busiest_user(spark, sf_dir):
    """User with most kept lines (the smallest id of several) and that user's last second."""
    kept = parse.keep_datatype1(_records(spark, sf_dir))
    user = X.field(F.col("fields"), 1).cast("bigint").alias("user_id")
    per_user = kept.groupBy(user).agg(F.count("*").alias("n"), F.max("sec").alias("last_sec"))
    return per_user.orderBy(F.desc("n"), "user_id").first()


@query
def point_get(spark, sf_dir):
    user = _busiest_user(spark, sf_dir)
    settings = inputs.loaded(spark, sf_dir)
    return table.point_get(spark, settings, user["user_id"], user["last_sec"])


@query
def user_scan(spark, sf_dir):
    user = _busiest_user(spark, sf_dir)
    return table.user_scan(spark, inputs.loaded(spark, sf_dir), user["user_id"])


@query
def user_time_range(spark, sf_dir):
    """The busiest user's rows of 10 to 19 January 2024."""
    user = _busiest_user(spark, sf_dir)
    settings = inputs.loaded(spark, sf_dir)
    return table.user_time_range(spark, settings, user["user_id"], 1_704_844_800, 1_705_708_800)


@query
def sql_user_read(spark, sf_dir):
    """The busiest user's rows by the table's SQL function."""
    user = _busiest_user(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {inputs.loaded(spark, sf_dir).table}_user('{user['user_id']}')")


@query
def merged_view(spark, sf_dir):
    """The view over split regions and merged buckets."""
    return spark.table(f"{inputs.merged(spark, sf_dir).table}_view")


@query
def retention_stored(spark, sf_dir):
    """Stored rows still served at 5 March 2024, when the first of the dated loads has expired; its buckets aren't opened."""
    settings = inputs.dated(spark, sf_dir)
    as_of = F.timestamp_seconds(F.lit(1_709_596_800))
    return table.serving(spark, settings, as_of, ledger.read_ledger(spark, settings.ledger_path)).select("userid_ts", "payload")


@query
def location_refreshes(spark, sf_dir):
    """Location of each key as of its load, over three loads with a refresh each."""
    return spark.table(inputs.dated(spark, sf_dir).table).select("bucket_ts", "userid_ts", "location_history")


# --- enrichment -----------------------------------------------------------------------


@query
def location_enrich(spark, sf_dir):
    """Nations as operators: region and nation number stand for the two-part code."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    operator = nation.select(
        F.col("n_regionkey").alias("mcc"), F.col("n_nationkey").alias("mnc"), F.col("n_name").alias("location")
    )
    home = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").alias("user_id"), F.col("n_regionkey").alias("mcc"), F.col("n_nationkey").alias("mnc")
    )
    seen = inputs.events(spark, sf_dir).select("event_id", "user_id").join(home, "user_id", "left")
    return enrich.with_location(seen, operator).select(
        "event_id", "user_id", "mcc", "mnc", "location_history"
    )


@query
def location_refresh_due(spark, sf_dir):
    """Loads that would find the dimension stale, when each week's first load re-reads it."""
    week = bucket_start(F.col("started"), 7 * inputs.DAY_SECONDS).alias("week")
    log = inputs.load_log(spark, sf_dir).select("iteration", "started", week)
    refreshed = log.groupBy("week").agg(F.min("started").alias("last_refresh"))
    due = enrich.refresh_due(F.col("started"), F.col("last_refresh"), 24)
    return log.join(refreshed, "week").select("iteration", "last_refresh", due.alias("due"))


# --- streaming ------------------------------------------------------------------------


def _stored(spark, settings):
    return spark.table(settings.table).select("bucket_ts", "region", "userid_ts", "payload")


@query
def stream_load(spark, sf_dir):
    """All day buckets announced at once and loaded ten to a micro-batch."""
    settings = inputs.new_settings(spark, "stream", buckets_per_load=10)
    listing, checkpoint = new_folder(spark, "ready"), new_folder(spark, "offsets")
    manifest.announce(inputs.folders(spark, sf_dir), listing)
    start_load_stream(LoadJob(spark, settings), listing, checkpoint).awaitTermination()
    return _stored(spark, settings)


@query
def late_bucket(spark, sf_dir):
    """The second half of the month is loaded first. Then the first half turns up, and
    the loaded buckets are announced again with another folder's content."""
    settings = inputs.new_settings(spark, "late", buckets_per_load=10)
    listing, checkpoint = new_folder(spark, "ready"), new_folder(spark, "offsets")
    folders = inputs.folders(spark, sf_dir)
    newer = F.col("bucket_ts") >= 1_705_276_800
    job = LoadJob(spark, settings)
    manifest.announce(folders.where(newer), listing)
    start_load_stream(job, listing, checkpoint).awaitTermination()
    manifest.announce(folders.where(~newer), listing)
    other = folders.where(~newer).agg(F.min("path")).first()[0]
    manifest.announce(folders.where(newer).withColumn("path", F.lit(other)), listing)
    start_load_stream(LoadJob(spark, settings), listing, checkpoint).awaitTermination()
    return _stored(spark, settings)
