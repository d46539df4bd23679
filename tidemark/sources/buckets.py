"""Delimited text in bucket folders ``<root>/<name>=<epoch>``."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket_of_file, parse_bucket_path
from tidemark.shared import many_folders


def read_buckets(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Lines of all folders as (``value``, ``bucket_ts``): one scan, copies kept.

    ``paths`` is a list or a comma-separated text. The epoch comes from partition
    discovery, one scan per root, so that neither the number of roots nor what lies
    in a bucket folder (files with ``=`` in their names, subfolders) matters.
    """
    paths = [p for p in paths.split(",") if p] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], "value string, bucket_ts bigint")
    places: dict[tuple[str, str], list[str]] = {}
    for path in paths:
        root, name, _ = parse_bucket_path(path)
        places.setdefault((root, name), []).append(path)
    scans = []
    for (root, name), folders in places.items():
        scans.append(_scan(spark, root, name, folders))
    return reduce(DataFrame.unionAll, scans)


def _scan(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    """Folders of one root. If some have partition-like subfolders and others don't, partition discovery refuses them; then the
    epoch is taken from the file's path, where it is the folder right below the root."""
    try:
        reader = spark.read.schema(f"value string, `{name}` bigint").option("basePath", root)
        return reader.text(folders).select("value", F.col(name).alias("bucket_ts"))
    except Exception as error:
        if "CONFLICTING_PARTITION_COLUMN_NAMES" not in str(error):
            raise
    step = f"/{re.escape(name)}=([0-9]+)(?=/)"
    above = len(re.findall(step, f"{root}/"))
    epochs = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit(step), F.lit(1))
    lines = spark.read.text(folders, recursiveFileLookup=True)
    return lines.select("value", F.get(epochs, F.lit(above)).cast("bigint").alias("bucket_ts"))


def discover_buckets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with the epoch found in the path of the file they came from."""
    lines = spark.read.text(paths, recursiveFileLookup=True)
    return lines.select("value", bucket_of_file(F.col("_metadata.file_path")).alias("bucket_ts"))


def write_buckets(lines: DataFrame, root: str, name: str = "ts") -> None:
    """Write (``value``, ``bucket_ts``) as bucket folders, the form a load reads.

    Rebalancing by bucket gives each folder few files, and cuts a hot bucket up.
    """
    renamed = lines.select("value", F.col("bucket_ts").alias(name))
    with many_folders(lines.sparkSession):
        renamed.hint("rebalance", name).write.partitionBy(name).text(root)
