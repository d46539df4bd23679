"""One load: a bounded batch of buckets from folders into the serving table."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import parse_bucket_path
from tidemark.functions.fields import DATATYPE2_ARITIES
from tidemark.operators import compaction, enrich, ledger, metrics, parse, quality, region_set, table
from tidemark.operators.claims import Claims, Failures, held
from tidemark.settings import LoadSettings
from tidemark.sources.buckets import read_buckets
from tidemark.sources.dimension import location_of_settings

log = logging.getLogger(__name__)

EXPIRY_SECONDS = 3600
"""A job frees what has expired with its first load, then at most this often."""
RETRY_SECONDS = 600
"""How long a bucket that failed by itself waits for its next try; twice as long each time."""


@dataclass(frozen=True)
class LoadResult:
    batch_id: int
    buckets: int
    seen: int
    dropped: int
    too_long: int
    started: int
    finished: int


class LoadJob:
    """Creates what is missing and loads batches; all state is in shared storage.

    ``locate`` adds ``location_history`` to keyed rows, given the dimension. It is
    called only with ``settings.resolve_location``. Without ``dimension`` the location table of the settings is read.
    """

    def __init__(
        self,
        spark: SparkSession,
        settings: LoadSettings,
        dimension: Callable[[], DataFrame] | None = None,
        locate: Callable[[DataFrame, enrich.RefreshedDimension], DataFrame] | None = None,
        clock: Callable[[], float] = time.time,
    ) -> None:
        if settings.resolve_location and dimension is None and settings.db_kind:
            dimension = lambda: location_of_settings(spark, settings)
        if settings.resolve_location and (dimension is None or locate is None):
            raise ValueError("resolve_location needs a dimension and a locate step")
        self.spark = spark
        self.settings = settings
        self._clock = clock
        self._locate = locate
        self.bounds = table.create_table(spark, settings)
        self.regions, self._region_files = table.table_regions(spark, settings), None
        table.create_view(spark, settings, f"{settings.table}_view")
        table.create_functions(spark, settings, self.regions)
        self._ledger = ledger.ledger_table(spark, settings.ledger_path)
        self._ledger_files: list[str] | None = None
        self._chosen_files: list[str] | None = None
        self._recent: list[Row] | None = None
        self._claims = Claims(spark, settings.claims_path, settings.claim_seconds, clock)
        self._failures = Failures(spark, settings.failures_path)
        self._failed: dict[str, dict] = {}
        self._failed_now: set[str] = set()
        self._was_last = False
        self._stats: list[list[Row]] = []
        self._units_allowed = settings.compact_units
        self.location = None
        if settings.resolve_location:
            self.location = enrich.RefreshedDimension(
                dimension, settings.refresh_hours, int(clock()), settings.location_path
            )
        self._freed: int | None = None
        self._writes = 0
        self._metrics({metrics.APPLICATION_ID: spark.sparkContext.applicationId})

    def run(self, ready: Callable[[], DataFrame], listing: DataFrame | None = None) -> list[LoadResult]:
        """Load batch after batch until no ready bucket is left. A batch that fails doesn't hold up the others; its error is raised in the end."""
        results, first_error = [], None
        self._failed_now = set()
        while True:
            try:
                result = self.load(ready(), listing)
            except Exception as error:  # its buckets are set aside; the others go on
                log.exception("a load failed")
                first_error = first_error or error
                continue
            if result is None:
                break
            results.append(result)
            if self._was_last:
                break
        self._failed_now = set()
        if first_error is not None:
            raise first_error
        return results

    def load(self, ready: DataFrame, listing: DataFrame | None = None) -> LoadResult | None:
        """Load the next batch of ``ready`` (``bucket_ts``, ``path``); None if all are done or in other hands.

        ``listing`` is the whole ready list for the backlog metrics, when ``ready`` is a part.

        The job claims buckets before it loads them, so that jobs on one ledger share the work. The
        ledger is written after the data. A load that stops in between leaves partitions without a ledger
        row, which the next try replaces as a whole.
        """
        started = int(self._clock())
        self._refresh_location(started)
        batch, processed = self._choose(ready)
        if not batch:
            return None
        names = [row["bucket_ts"] for row in batch]
        try:
            result = self._load(batch, names, processed, ready if listing is None else listing, started)
        except Exception as error:
            self._set_aside(batch, error)
            raise
        finally:
            self._claims.release(names)
        if self._failed:
            self._failures.forget(names)
        self._keep_house(result.finished)
        return result

    def _choose(self, ready: DataFrame) -> tuple[list[Row], DataFrame]:
        """The next buckets, claimed, and the ledger: those of the first paths that are in no one's hands and have not failed,
        else one that has failed and is due again."""
        size = self.settings.buckets_per_load
        while True:
            files = self._chosen_files = self._ledger.files()
            processed = self._ledger.read(files)
            self._failed = self._failures.read()
            apart = {*self._claims.held_by_others(), *self._failed}
            waiting = ledger.pending(ledger.unique_buckets(ready), processed)
            if apart:
                waiting = waiting.where(~F.col("bucket_ts").cast("string").isin(sorted(apart)))
            batch = ledger.next_batch(waiting, size).collect()
            self._was_last = len(batch) < size and not apart
            batch = batch or self._due(processed)
            if not batch:
                return [], processed
            mine = [row for row in batch if self._claims.take(row["bucket_ts"])]
            if mine and self._ledger.files() != files:
                # another job may have finished and let go of a bucket since the ledger was read
                names = [row["bucket_ts"] for row in mine]
                processed = self._ledger.read()
                done = {r[0] for r in processed.where(F.col("bucket_ts").isin(names)).select("bucket_ts").collect()}
                self._claims.release(done)
                mine = [row for row in mine if row["bucket_ts"] not in done]
            if mine:
                return mine, processed

    def _due(self, processed: DataFrame) -> list[Row]:
        """One failed bucket whose time has come, by itself, so that it takes no other with it."""
        others = self._claims.held_by_others()
        others |= self._failed_now
        due = [f for name, f in sorted(self._failed.items()) if f["until"] <= self._clock() and name not in others]
        for failure in due:
            if processed.where(F.col("bucket_ts") == failure["bucket_ts"]).take(1):
                self._failures.forget([failure["bucket_ts"]])
                continue
            return [Row(bucket_ts=failure["bucket_ts"], path=failure["path"])]
        return []

    def _set_aside(self, batch: list[Row], error: Exception) -> None:
        alone = len(batch) == 1
        self._failed_now |= {str(row["bucket_ts"]) for row in batch if alone}
        for row in batch:
            before = self._failed.get(str(row["bucket_ts"]), {"failures": 0})["failures"]
            wait = RETRY_SECONDS * 2 ** min(before - 1, 10) if alone and before else 0
            self._failures.note(row["bucket_ts"], row["path"], before + 1, self._clock() + wait, str(error)[:500])

    def _load(self, batch: list[Row], names: list[int], processed: DataFrame, listing: DataFrame, started: int) -> LoadResult:
        for row in batch:
            if parse_bucket_path(row["path"])[2] != row["bucket_ts"]:
                raise ValueError(f"entry {row['bucket_ts']} names another bucket: {row['path']}")
        recent = self._recent_loads(processed)
        backlog = self._backlog(listing, processed, batch[-1])
        self._before(batch[-1], started, recent, backlog["ahead"])
        paths = [row["path"] for row in batch]
        if self.settings.mode == "datatype1":
            counts = self._write(paths, names, started)
        else:
            counts = self._count(paths, quality.arity_counts(DATATYPE2_ARITIES))
        finished = int(self._clock())
        batch_id = self._new_batch_id(max((row["iteration"] for row in recent), default=0) + 1)
        try:
            result = LoadResult(
                batch_id,
                len(batch),
                counts["n_split"],
                counts["split_drop"],
                counts.get("key_drop", 0),
                started,
                finished,
            )
            self._mark(batch, result)
        finally:
            self._claims.release([f"load-{batch_id}"])
        self._after(result, paths, names, backlog["ready"], backlog["processed"] + len(batch))
        return result

    def _new_batch_id(self, number: int) -> int:
        """The number no other job has; claimed until the ledger holds it."""
        while True:
            while not self._claims.take(f"load-{number}"):
                number += 1
            if self._ledger.files() == self._chosen_files:
                return number
            # another job may have written this number and let go of it since the ledger was read
            last = self._ledger.read().agg(F.max("batch_id")).first()[0] or 0
            if last < number:
                return number
            self._claims.release([f"load-{number}"])
            number = last + 1

    def _recent_loads(self, processed: DataFrame) -> list[Row]:
        """The last loads' times; what this job wrote itself it knows, as long as no other job wrote."""
        if self._recent is None or self._ledger.files() != self._ledger_files:
            self._recent = metrics.recent_loads(ledger.load_log(processed)).collect()
        return self._recent

    def _mark(self, batch: list, result: LoadResult) -> None:
        files = self._ledger.files()
        times = [datetime.fromtimestamp(t, UTC) for t in (result.started, result.finished)]
        counts = [getattr(result, name) for name in ledger.LOAD_COUNTS]
        rows = [(row["bucket_ts"], row["path"], result.batch_id, *times, *counts) for row in batch]
        ledger.mark_processed(rows, self.settings.ledger_path, self.spark)
        own = Row(iteration=result.batch_id, load_time=(result.finished - result.started) // result.buckets)
        self._recent = [own, *self._recent][: metrics.TRAILING_LOADS] if files == self._ledger_files or not files else None
        self._ledger.fold()
        self._ledger_files = self._ledger.files()

    # --- upkeep --------------------------------------------------------------------

    def _keep_house(self, now: int) -> None:
        """What follows a load: split hot regions, merge buckets, free expired ones. Each is due only now and then."""
        settings = self.settings
        if settings.split_every and len(self._stats) >= settings.split_every:
            self.split_regions()
        if settings.compact_units and len(compaction.stored_units(self.spark, settings)) >= self._units_allowed:
            self.compact()
            # tiers that aren't full may hold many units: the next look is after as many loads as fill one
            self._units_allowed = len(compaction.stored_units(self.spark, settings)) + settings.compact_units // 2
        if self._freed is None or now - self._freed >= EXPIRY_SECONDS:
            done = self._ledger.read()
            freed = table.drop_expired(self.spark, settings, done, F.timestamp_seconds(F.lit(now)))
            self._freed = now if len(freed) < table.EXPIRY_PORTION else None

    def compact(self) -> list[int]:
        """Merge stored buckets as far as tiers are full; also for a job of its own beside the loads."""
        now = F.timestamp_seconds(F.lit(int(self._clock())))
        return compaction.compact(self.spark, self.settings, self.regions, self._ledger.read(), now)

    def split_regions(self) -> dict[int, int]:
        """Split the regions that got far more rows than the mean in the loads since the last look.

        Statistics are one row and one sketch a region and load. Jobs that run at once each look at their own loads;
        a region is split by one of them at a time.
        """
        spark, settings = self.spark, self.settings
        if not self._stats:
            return {}
        with held(spark, settings.root, "_regions", 600) as mine:
            self.regions = table.table_regions(spark, settings)
            counts: dict[int, int] = {}
            for load in self._stats:
                for row in load:
                    counts[row["region"]] = counts.get(row["region"], 0) + row["n_rows"]
            hot = region_set.hot_regions(counts, self.regions, settings.regions) if mine else {}
            if hot:
                rows = [tuple(row) for load in self._stats for row in load if row["region"] in hot]
                stats = region_set.merged_stats(spark.createDataFrame(rows, region_set.STATS_SCHEMA))
                new = region_set.split_rows(self.regions, region_set.split_points(stats, hot))
                if new:
                    table.regions_table(spark, settings).append(new)
                    self.regions = table.table_regions(spark, settings)
                    self.bounds = self.regions.bounds
                    table.create_functions(spark, settings, self.regions)
        self._stats = []
        return hot

    # --- data ----------------------------------------------------------------------

    def _write(self, paths: list[str], names: list[int], started: int) -> dict[str, int]:
        """Publish the lines of a batch; an error unless every line kept is stored afterwards."""
        spark, settings = self.spark, self.settings
        records = parse.with_fields(read_buckets(spark, paths))
        records, observed = quality.observed(records, quality.datatype1_counts())
        kept = parse.keep_datatype1(records)
        keyed = parse.keep_storable_keys(parse.keyed_payloads(kept, carry=("bucket_ts",)))
        if self.location is not None:
            keyed = self._locate(keyed, self.location)
        else:
            keyed = keyed.withColumn("location_history", F.lit(None).cast("string"))
        self._see_regions()
        rows = keyed.withColumn("region", self.regions.column("userid_ts")).withColumn(
            "loaded_at", F.timestamp_seconds(F.lit(started))
        )
        table.drop_buckets(spark, settings, names)
        table.publish(rows, settings)
        stats = region_set.region_stats(spark.table(settings.table).where(F.col("bucket_ts").isin(names)), self.regions).collect()
        stored = sum(row["n_rows"] for row in stats)
        kept = lambda c: c["n_split"] - c["split_drop"] - c["key_drop"]
        if stored:
            counts = observed.get
            if stored == kept(counts):
                self._stats.append(stats)
                return counts
        # nothing to observe, or tasks counted twice after an executor was lost
        counts = self._count(paths, quality.datatype1_counts())
        if stored != kept(counts):
            raise RuntimeError(f"{stored} rows are stored of {kept(counts)} in buckets {names}")
        return counts

    def _see_regions(self) -> None:
        """Each load asks for the live regions; their files are read again only if another job has split one."""
        files = table.regions_table(self.spark, self.settings).files()
        if files != self._region_files:
            self.regions, self._region_files = table.table_regions(self.spark, self.settings), files

    def _count(self, paths: list[str], counts: list[Column]) -> dict[str, int]:
        records = parse.with_fields(read_buckets(self.spark, paths))
        return quality.quality_counters(records, counts).first().asDict()

    def _refresh_location(self, now: int) -> None:
        if self.location is not None and self.location.refresh(now):
            self._metrics({metrics.LOCATION_UPDATED: now})

    # --- metrics -------------------------------------------------------------------

    def _metrics(self, values: dict[str, object]) -> None:
        self._writes += 1
        metrics.write_metrics(self.spark, self.settings.metrics_path, values, fold=self._writes % 16 == 1)

    def _backlog(self, listing: DataFrame, processed: DataFrame, bucket) -> Row:
        """Sizes of both lists, and how many waiting buckets are newer than ``bucket``."""
        is_ready, is_done = F.col("ready").isNotNull(), F.col("done").isNotNull()
        ready = ledger.unique_buckets(listing).select("bucket_ts", F.lit(1).alias("ready"))
        done = processed.select("bucket_ts", F.lit(1).alias("done"))
        newer = F.col("bucket_ts") > bucket["bucket_ts"]
        both = ready.join(done, "bucket_ts", "full")
        return both.agg(
            F.count_if(is_ready).alias("ready"),
            F.count_if(is_done).alias("processed"),
            F.count_if(is_ready & ~is_done & newer).alias("ahead"),
        ).first()

    def _before(self, bucket, started: int, recent: list[Row], ahead: int) -> None:
        times = [row["load_time"] for row in recent]
        lag = started - bucket["bucket_ts"]
        self._metrics(
            {
                metrics.MEAN_LOAD_TIME: sum(times) // len(times) if times else None,
                metrics.CURRENT_PATH: bucket["path"],
                metrics.CURRENT_TS: bucket["bucket_ts"],
                metrics.DELAY_OVERALL: lag,
                metrics.DELAY_LOADER: lag,
                metrics.BUCKETS_AHEAD: ahead,
            }
        )

    def _after(
        self, result: LoadResult, paths: list[str], names: list[int], ready: int, processed: int
    ) -> None:
        self._metrics(
            {
                metrics.READY_COUNT: ready,
                metrics.PROCESSED_COUNT: processed,
                metrics.LAST_PATH: ",".join(paths),
                metrics.LAST_TS: ",".join(map(str, names)),
                metrics.LAST_LOAD_TIME: (result.finished - result.started) // result.buckets,
            }
        )
        log.info("loaded batch %d: %s", result.batch_id, result)
