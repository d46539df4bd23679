"""Job arguments and their fallbacks."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

log = logging.getLogger(__name__)

# --- fixed values: defaults and codec names a load accepts -------------------
DEFAULT_REGIONS = 100
DEFAULT_CODEC = "gzip"
DEFAULT_TTL_SECONDS = 2_592_000
CODECS = {
    "GZ": "gzip",
    "GZIP": "gzip",
    "LZ4": "lz4",
    "NONE": "none",
    "SNAPPY": "snappy",
    "ZSTD": "zstd",
}
SETTING_NAMES = {
    "executionMode": "mode",
    "numberOfBucketsToProcessInOneIteration": "buckets_per_load",
    "outputTable": "table",
    "hbaseNumberOfRegions": "regions",
    "hbaseTableCompression": "compression",
    "cfTTL": "ttl_seconds",
    "resolveLocation": "resolve_location",
    "locDataUpdateFreq": "refresh_hours",
    "sqlCreateViewQuery": "view_sql",
    "dbType": "db_kind",
    "pgConnString": "postgresql_url",
    "oracleConnString": "oracle_url",
    "dbUser": "db_user",
    "dbPass": "db_password",
    "dbLocationTable": "db_table",
}
# -----------------------------------------------------------------------------


def codec_or_default(name: str | None) -> str:
    """Parquet codec for a compression name; an unknown name falls back to gzip."""
    codec = CODECS.get((name or "").upper())
    if codec is None:
        log.warning("compression %r is not available, using %s", name, DEFAULT_CODEC)
        return DEFAULT_CODEC
    return codec


def regions_or_default(value: object) -> int:
    """Region count; text that is no whole number falls back to 100, and below 1 there is one region."""
    try:
        return max(1, int(str(value)))
    except ValueError:
        log.warning("region count %r is not usable, using %d", value, DEFAULT_REGIONS)
        return DEFAULT_REGIONS


@dataclass
class LoadSettings:
    """What one load job needs to know.

    ``root`` is a folder all executors reach. The table, its region bounds, the
    processed ledger and the metrics live below it. ``claim_seconds`` is how long a bucket stays claimed by a
    job that is gone, ``split_every`` after how many loads hot regions are split, ``compact_units`` how many
    buckets (or merged ones of a size) are merged into one; 0 turns the latter two off. The ``db`` settings name the
    location table; with a whole-number ``db_partition_column`` it is read over ``db_connections`` at once.
    """

    table: str
    root: str
    mode: str = "datatype1"
    buckets_per_load: int = 1
    regions: int = DEFAULT_REGIONS
    compression: str = DEFAULT_CODEC
    ttl_seconds: int = DEFAULT_TTL_SECONDS
    resolve_location: bool = False
    refresh_hours: int = 24
    view_sql: str | None = None
    claim_seconds: int = 6 * 3600
    split_every: int = 8
    compact_units: int = 48
    db_kind: str | None = None
    postgresql_url: str | None = None
    oracle_url: str | None = None
    db_user: str = ""
    db_password: str = field(default="", repr=False)
    db_table: str | None = None
    db_partition_column: str | None = None
    db_connections: int = 1

    def __post_init__(self) -> None:
        if self.mode not in ("datatype1", "datatype2"):
            raise ValueError(f"mode must be datatype1 or datatype2, not {self.mode!r}")
        self.buckets_per_load = int(self.buckets_per_load)
        if self.buckets_per_load < 1:
            raise ValueError("buckets_per_load must be at least 1")
        self.regions = regions_or_default(self.regions)
        self.compression = codec_or_default(self.compression)
        self.ttl_seconds = int(self.ttl_seconds)
        self.refresh_hours = int(self.refresh_hours)
        self.db_connections = int(self.db_connections)
        if isinstance(self.resolve_location, str):
            self.resolve_location = self.resolve_location == "true"
        self.root = self.root.rstrip("/")

    @classmethod
    def from_mapping(cls, values: Mapping[str, object], root: str) -> LoadSettings:
        """Build from setting names as operators write them; empty text means unset."""
        known = {f.name for f in fields(cls)}
        args = {
            SETTING_NAMES.get(name, name): value for name, value in values.items() if value != ""
        }
        return cls(root=root, **{k: v for k, v in args.items() if k in known and k != "root"})

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def bounds_path(self) -> str:
        return f"{self.root}/regions"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/processed"

    @property
    def expired_path(self) -> str:
        return f"{self.root}/expired"

    @property
    def claims_path(self) -> str:
        return f"{self.root}/claims"

    @property
    def failures_path(self) -> str:
        return f"{self.root}/failures"

    @property
    def stats_path(self) -> str:
        return f"{self.root}/region_stats"

    @property
    def merges_path(self) -> str:
        return f"{self.root}/merges"

    @property
    def location_path(self) -> str:
        return f"{self.root}/location"

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/metrics"
