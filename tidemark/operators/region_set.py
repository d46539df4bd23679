"""The regions of a table over time: live ones, those that were split, and where a key may lie.

A region has a number for good. When a hot region is split, its children take new numbers and it stays as their
parent: buckets stored before keep it, later ones use the children. So a key lies in its live region or in one of
that region's ancestors, whatever the bucket.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.regions import KEY_CEILING, region_of
from tidemark.operators.layout import live_region_bounds

REGION_SCHEMA = "region int, start_key string, parent int"
SPLIT_ABOVE = 1.5
"""A region is hot if it gets this multiple of the mean rows of a load."""
PIECE = 0.6
"""Rows of the pieces of a hot region, as a share of that mean."""
MOST_REGIONS_FACTOR = 8
"""A table has at most this multiple of the regions it began with."""
KEY_BYTES = 7
"""Bytes of a key behind its region's common prefix that a sketch tells apart."""
STATS_SCHEMA = "region int, loads bigint, n_rows bigint, sketch binary"


@dataclass(frozen=True)
class Region:
    number: int
    low: str
    high: str | None
    parent: int | None
    ancestors: tuple[int, ...] = ()

    @property
    def prefix(self) -> str:
        """What all keys of the region begin with, as far as its bounds tell."""
        if self.high is None:
            return ""
        n = 0
        while n < min(len(self.low), len(self.high)) and self.low[n] == self.high[n]:
            n += 1
        return self.low[:n]


@dataclass
class RegionSet:
    """All regions a table ever had: (number, start key, parent) rows, region 0 from the empty key being understood."""

    rows: list[tuple[int, str, int | None]]
    regions: dict[int, Region] = field(init=False)
    live: list[Region] = field(init=False)

    def __post_init__(self) -> None:
        children: dict[int | None, list[tuple[str, int]]] = {None: [("", 0)]}
        for number, start, parent in self.rows:
            children.setdefault(parent, []).append((start, number))
        self.regions = {}
        todo: list[tuple[int | None, str | None, tuple[int, ...]]] = [(None, None, ())]
        while todo:
            parent, high, line = todo.pop()
            own = sorted(children.get(parent, []))
            for (start, number), end in zip(own, [*[s for s, _ in own[1:]], high]):
                self.regions[number] = Region(number, start, end, parent, line)
                todo.append((number, end, (*line, number)))
        self.live = sorted((r for r in self.regions.values() if r.number not in children), key=lambda r: r.low)

    @property
    def bounds(self) -> list[str]:
        """Start keys of the live regions but the first."""
        return [r.low for r in self.live[1:]]

    def of(self, key: str) -> Region:
        return self.live[bisect_right(self.bounds, key)]

    def holding(self, low: str, high: str) -> list[int]:
        """Numbers of all regions, live or split since, that keys from ``low`` to ``high`` may lie in."""
        bounds = self.bounds
        found = self.live[bisect_right(bounds, low) : bisect_right(bounds, high) + 1]
        return sorted({n for r in found for n in (r.number, *r.ancestors)})

    def holding_prefix(self, prefix: str) -> list[int]:
        return self.holding(prefix, prefix + KEY_CEILING)

    def column(self, key: str) -> Column:
        """The live region's number of a key column."""
        place = region_of(key, self.bounds)
        numbers = [r.number for r in self.live]
        if numbers == list(range(len(numbers))):
            return place
        return F.get(F.expr(f"array({', '.join(map(str, numbers))})"), place)

    def paths_sql(self, key: str) -> str:
        """SQL text: the live region's number and its ancestors' for the key expression ``key``, as an array."""
        paths = ", ".join(f"array({', '.join(map(str, (r.number, *r.ancestors)))})" for r in self.live)
        bounds = ", ".join(f"cast(X'{b.encode().hex()}' as string)" for b in self.bounds) or "cast(null as string)"
        return f"get(array({paths}), size(filter(array({bounds}), b -> b <= {key})))"

    def range_sql(self, low: str, high: str) -> str:
        """SQL text: all numbers that keys between the expressions ``low`` and ``high`` may lie in, as an array."""
        paths = ", ".join(f"array({', '.join(map(str, (r.number, *r.ancestors)))})" for r in self.live)
        bounds = ", ".join(f"cast(X'{b.encode().hex()}' as string)" for b in self.bounds) or "cast(null as string)"
        place = lambda key: f"size(filter(array({bounds}), b -> b <= {key}))"
        return f"flatten(slice(array({paths}), {place(low)} + 1, {place(high)} - {place(low)} + 1))"


def read_regions(spark: SparkSession, paths: str | Sequence[str]) -> RegionSet:
    """From the files of all splits; there is one row for each region ever made."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.schema(REGION_SCHEMA).parquet(*paths).collect()
    return RegionSet([(r["region"], r["start_key"], r["parent"]) for r in rows])


def live_bounds(regions: DataFrame) -> DataFrame:
    """The same set by DataFrame steps: split parents and the empty start key don't count."""
    parents = regions.select(F.col("parent").alias("region")).where("region IS NOT NULL").distinct().withColumn("is_split", F.lit(True))
    marked = regions.join(parents, "region", "left").withColumn("is_split", F.coalesce("is_split", F.lit(False)))
    return live_region_bounds(marked)


# --- statistics of loads ---------------------------------------------------------------


def key_number(regions: RegionSet, key: str = "userid_ts", region: str = "region") -> Column:
    """The ``KEY_BYTES`` bytes of a key behind its region's prefix as a number of the same order."""
    prefixes = [(r.number, len(r.prefix.encode())) for r in regions.live if r.prefix]
    skip = F.lit(0)
    if prefixes:
        known = ", ".join(f"{n}, {size}" for n, size in prefixes)
        skip = F.coalesce(F.try_element_at(F.expr(f"map({known})"), F.col(region)), F.lit(0))
    rest = F.substring(F.col(key).cast("binary"), skip + 1, F.lit(KEY_BYTES))
    return F.conv(F.rpad(F.hex(rest), 2 * KEY_BYTES, "0"), 16, 10).cast("bigint")


def region_stats(rows: DataFrame, regions: RegionSet) -> DataFrame:
    """One load's rows of each region, with a quantile sketch of their keys: a partial aggregate, no shuffle of rows."""
    number = rows.select("region", key_number(regions).alias("number"))
    counted = number.groupBy("region").agg(F.count("*").alias("n_rows"), F.kll_sketch_agg_bigint("number").alias("sketch"))
    return counted.select("region", F.lit(1).cast("bigint").alias("loads"), "n_rows", "sketch")


def merged_stats(stats: DataFrame) -> DataFrame:
    """Statistics of several loads as one: KLL sketches merge, whatever their order."""
    return stats.groupBy("region").agg(
        F.sum("loads").alias("loads"), F.sum("n_rows").alias("n_rows"), F.kll_merge_agg_bigint("sketch").alias("sketch")
    )


def hot_regions(counts: dict[int, int], regions: RegionSet, start: int) -> dict[int, int]:
    """Into how many pieces each hot region of these loads should go; ``counts`` are rows by region number."""
    own = {r.number: counts.get(r.number, 0) for r in regions.live}
    mean = sum(own.values()) / len(own)
    room = MOST_REGIONS_FACTOR * start - len(own)
    out = {}
    for number, n in sorted(own.items(), key=lambda x: -x[1]):
        pieces = min(math.ceil(n / (PIECE * mean)) if mean else 0, room + 1)
        if n > SPLIT_ABOVE * mean and pieces > 1:
            out[number] = pieces
            room -= pieces - 1
    return out


def split_points(stats: DataFrame, hot: dict[int, int]) -> dict[int, list[int]]:
    """Quantiles of the key numbers of hot regions that cut them into equal pieces."""
    out = {}
    for row in stats.where(F.col("region").isin(list(hot))).collect():  # at most one sketch a region
        frame = stats.sparkSession.createDataFrame([(row["sketch"],)], "sketch binary")
        ranks = F.array(*[F.lit(k / hot[row["region"]]) for k in range(1, hot[row["region"]])])
        out[row["region"]] = list(frame.select(F.kll_sketch_get_quantile_bigint("sketch", ranks).alias("q")).first()["q"])
    return out


def key_at(region: Region, number: int) -> str:
    """The least text behind the region's prefix with a number, or a little less where bytes are no whole character."""
    raw = number.to_bytes(KEY_BYTES, "big").rstrip(b"\0")
    return region.prefix + raw.decode("utf-8", "ignore")


def split_rows(regions: RegionSet, points: dict[int, list[int]]) -> list[tuple[int, str, int]]:
    """New (number, start key, parent) rows; a region whose keys can't be told apart stays whole."""
    number = max(regions.regions) + 1
    out = []
    for parent in sorted(points):
        region = regions.regions[parent]
        # a number that is several quantiles stands for many keys: it becomes a region of its own, which is split further next time
        wanted = {m for n in points[parent] for m in ((n, n + 1) if points[parent].count(n) > 1 else (n,))}
        starts = sorted({key for n in wanted if (key := key_at(region, n)) > region.low and (region.high is None or key < region.high)})
        if starts:
            for start in [region.low, *starts]:
                out.append((number, start, parent))
                number += 1
    return out
