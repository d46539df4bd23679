"""Region bounds and the two physical layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regions import region_of


def live_region_bounds(regions: DataFrame) -> DataFrame:
    """Numbered start keys of the live regions.

    Split parents and the empty first start key do not count. The set has one entry
    per region, duplicates are removed map-side, and every use of it needs it as one
    sorted array, so it is aggregated into one.
    """
    live = regions.where(~F.col("is_split") & (F.col("start_key") != ""))
    keys = live.agg(F.array_sort(F.collect_set("start_key")).alias("keys"))
    return keys.select(F.posexplode("keys").alias("at", "start_key")).select(
        (F.col("at") + 1).alias("region"), "start_key"
    )


def with_region(keyed: DataFrame, bounds: Sequence[str], key: str = "userid_ts") -> DataFrame:
    return keyed.withColumn("region", region_of(key, bounds))


def by_region(placed: DataFrame, *groups: str) -> DataFrame:
    """Rows of a (``groups``, region) together and sorted by key: the layout of a load.

    One shuffle, no sampling pass over the input. ``rebalance`` lets adaptive
    execution cut a hot group into several tasks by the sizes it measured (even when
    the group is one single key) and pack small ones; the sort is inside each task.
    """
    return placed.hint("rebalance", *groups, "region").sortWithinPartitions(
        *groups, "region", "userid_ts"
    )


def by_key_range(
    placed: DataFrame, *order: str, parts: int | None = None, copies: bool = False
) -> DataFrame:
    """Rows in disjoint, ordered key ranges, each sorted: a total order over partitions.

    The range shuffle samples its input, so hot regions are cut by key. With ``copies``
    a hot group of equal rows is cut as well: each row's position in its input partition
    takes part in the order. That position is stable only for a frame made of scans and
    row-wise steps; checkpoint anything else first.
    """
    columns = [F.col(name) for name in order]
    if copies:
        placed = placed.withColumn("_copy", F.monotonically_increasing_id())
        columns.append(F.col("_copy"))
    spread = (
        placed.repartitionByRange(parts, *columns) if parts else placed.repartitionByRange(*columns)
    )
    return spread.sortWithinPartitions(*columns).drop("_copy")
