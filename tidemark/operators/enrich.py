"""Optional location lookup and its refresh rule."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import file_names, new_folder

BROADCAST_BYTES = 64 << 20
OPERATOR_KEY = ("mcc", "mnc")


def small_enough(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the frame's values, measured by one aggregate, stay below ``limit`` bytes."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in frame.columns),
        F.lit(0),
    )
    size = frame.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")).first()
    return size["bytes"] <= limit


def one_per_key(dimension: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """A lookup gives one value per key: of several, the greatest text."""
    return dimension.groupBy(*on).agg(F.max(value).alias(value))


def with_location(
    rows: DataFrame,
    dimension: DataFrame,
    on: Sequence[str] = OPERATOR_KEY,
    value: str = "location",
    output: str = "location_history",
    broadcast: bool | None = None,
) -> DataFrame:
    """Left join with the dimension; rows without a match keep a null location.

    A dimension of checked size is broadcast. A larger one is joined by key, and
    adaptive execution splits the hot keys of the row side.
    """
    lookup = one_per_key(dimension, on, value).withColumnRenamed(value, output)
    if broadcast is None:
        broadcast = small_enough(dimension.select(*on, value))
    return rows.join(F.broadcast(lookup) if broadcast else lookup, list(on), "left")


def with_location_as_of(
    rows: DataFrame,
    snapshots: DataFrame,
    at: Column,
    on: Sequence[str] = OPERATOR_KEY,
    value: str = "location",
    output: str = "location_history",
) -> DataFrame:
    """Left join with the value that held at the epoch second ``at``: that of the last snapshot until then.

    A key that a snapshot doesn't hold has no value from then on. Each key's value becomes an interval to the next snapshot, so the
    join is by key with a range check, and a row meets as many candidates as there are snapshots at most.
    """
    dates = snapshots.select("valid_from").distinct()
    until = dates.select("valid_from", F.lead("valid_from").over(Window.orderBy("valid_from")).alias("_until"))  # one row a snapshot
    lookup = snapshots.groupBy(*on, "valid_from").agg(F.max(value).alias(output)).join(F.broadcast(until), "valid_from")
    keys = [f"_{k}" for k in on]
    lookup = lookup.select(*[F.col(k).alias(f"_{k}") for k in on], F.col("valid_from").alias("_from"), "_until", output)
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_{k}") for k in on])
    held = (F.col("_from") <= F.col("_at")) & (F.col("_until").isNull() | (F.col("_at") < F.col("_until")))
    return rows.withColumn("_at", at).join(lookup, same & held, "left").drop("_at", "_from", "_until", *keys)


def refresh_due(now: Column | int, last: Column | int, hours: int):
    """Whether more than ``hours`` have passed since the last refresh."""
    return (now - last) > hours * 3600


class RefreshedDimension:
    """Re-reads a dimension when it is due; asked once per load.

    Each reading is written below ``folder``, or the shared folder, and loads use that
    copy: its size is the one measured, and the source may change meanwhile. The copies stay, dated, so that rows
    can be given the value that held at another time.
    """

    def __init__(self, read: Callable[[], DataFrame], hours: int, started: int, folder: str | None = None) -> None:
        self._read = read
        self._hours = hours
        self._folder = folder
        self.last_refresh = started
        self._use(read(), started)

    def _use(self, frame: DataFrame, now: int) -> None:
        spark = frame.sparkSession
        self._folder = self._folder or new_folder(spark, "location")
        folder = f"{self._folder}/{now}-{uuid.uuid4().hex}"
        frame.write.parquet(folder)
        self.frame = spark.read.schema(frame.schema).parquet(folder)
        self.broadcast = small_enough(self.frame)

    def snapshots(self) -> DataFrame:
        """All readings with ``valid_from``, the epoch second of each."""
        spark = self.frame.sparkSession
        names = [n for n in file_names(spark, self._folder) if not n.startswith("_")]
        dated = [spark.read.schema(self.frame.schema).parquet(f"{self._folder}/{n}").withColumn("valid_from", F.lit(int(n.split("-")[0])).cast("bigint")) for n in names]
        return reduce(DataFrame.unionByName, dated)

    def refresh(self, now: int) -> bool:
        if not refresh_due(now, self.last_refresh, self._hours):
            return False
        self._use(self._read(), now)
        self.last_refresh = now
        return True
