"""Bucket epochs: from timestamps and from folder paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: cadence and path format --------------------------------------
BUCKET_SECONDS = 1_800
BUCKET_PATH = re.compile(r"^(?P<root>.+)/(?P<name>[^/=]+)=(?P<epoch>[0-9]+)/?$")
FILE_IN_BUCKET = "^.*/[^/=]+=([0-9]+)/"
# --------------------------------------------------------------------------------


def bucket_start(epoch_seconds: Column, width: int = BUCKET_SECONDS) -> Column:
    """Start of the bucket an epoch second falls into."""
    return epoch_seconds - F.pmod(epoch_seconds, F.lit(width))


def bucket_of_path(path: Column) -> Column:
    """Epoch in a bucket folder path: the text after the last ``=``."""
    return F.substring_index(path, "=", -1).try_cast("bigint")


def bucket_of_file(file_path: Column) -> Column:
    """Epoch of the innermost bucket folder a data file lies in."""
    return F.regexp_extract(file_path, FILE_IN_BUCKET, 1).try_cast("bigint")


def parse_bucket_path(path: str) -> tuple[str, str, int]:
    """(root, partition name, epoch) of one folder path; raises on other layouts."""
    match = BUCKET_PATH.match(path)
    if match is None:
        raise ValueError(f"bucket folder must end in '<name>=<epoch seconds>': {path!r}")
    return match["root"], match["name"], int(match["epoch"])
