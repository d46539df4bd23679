"""Counts of seen and dropped records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import fields as X
from tidemark.functions import payload as J


def arity_counts(arities: tuple[int, ...], fields: str = "fields") -> list[Column]:
    return [
        F.count("*").alias("n_split"),
        F.count_if(~X.has_arity(F.col(fields), arities)).alias("split_drop"),
    ]


def datatype1_counts(fields: str = "fields") -> list[Column]:
    """Arity counters, and the records of right arity whose key is too long to store."""
    f = F.col(fields)
    too_long = X.key_bytes(X.field(f, 1), X.field(f, 0)) > X.MAX_KEY_BYTES
    rejected = F.count_if(X.has_arity(f, X.DATATYPE1_ARITIES) & too_long)
    return [*arity_counts(X.DATATYPE1_ARITIES, fields), rejected.alias("key_drop")]


def presence_counts(value: str, prefix: str) -> list[Column]:
    return [
        F.count(value).alias(f"n_{prefix}"),
        F.count_if(F.col(value) == J.MISSING).alias(f"{prefix}_drop"),
    ]


def observed(records: DataFrame, counts: list[Column]) -> tuple[DataFrame, Observation]:
    """Count while the records pass by, without a pass of their own.

    An executor lost after its map tasks finished makes Spark run them again, and
    both runs are counted. Callers compare with what was written, or use
    ``quality_counters``.
    """
    observation = Observation()
    return records.observe(observation, *counts), observation


def quality_counters(records: DataFrame, counts: list[Column], *groups: str) -> DataFrame:
    """Exact counters per group, pre-aggregated map-side."""
    return records.groupBy(*groups).agg(*counts)
