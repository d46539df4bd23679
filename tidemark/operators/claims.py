"""Exclusive claims: files that are created if absent, with a lease."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.shared import create_file, delete_path, file_names, modified_at, move_path, path_exists, put_file, read_file

LEASE_SECONDS = 6 * 3600
"""A claim that is older counts as left behind by a job that is gone."""


class Claims:
    """Claims of one owner on names below ``path``. A name is claimed by whoever creates its file first."""

    def __init__(self, spark: SparkSession, path: str, lease_seconds: int = LEASE_SECONDS, clock: Callable[[], float] = time.time) -> None:
        self.spark, self.path, self.lease_seconds, self.clock = spark, path, lease_seconds, clock
        self.owner = uuid.uuid4().hex

    def _file(self, name: object) -> str:
        return f"{self.path}/{name}"

    def take(self, name: object) -> bool:
        """Whether the name is this owner's now. An expired claim is moved aside first; the file system lets one owner do so."""
        content = json.dumps({"owner": self.owner, "until": self.clock() + self.lease_seconds}).encode()
        if create_file(self.spark, self._file(name), content):
            return True
        held_by = self._read(name)
        if held_by is None:
            return create_file(self.spark, self._file(name), content)
        if held_by["owner"] == self.owner:
            return True
        if held_by["until"] > self.clock():
            return False
        aside = f"{self.path}/_old-{uuid.uuid4().hex}"
        try:
            move_path(self.spark, self._file(name), aside)
        except Exception:  # another owner was first
            return False
        moved = json.loads(read_file(self.spark, aside) or b"null")
        if moved is not None and moved["until"] > self.clock():
            # what was moved is a claim made meanwhile: it goes back, and this owner has none
            move_path(self.spark, aside, self._file(name))
            return False
        delete_path(self.spark, aside)
        return create_file(self.spark, self._file(name), content)

    def _read(self, name: object) -> dict | None:
        """Who holds a name; None if nobody does. A file without content is a claim that was never written to its end."""
        try:
            content = read_file(self.spark, self._file(name))
            return json.loads(content) if content else {"owner": "", "until": modified_at(self.spark, self._file(name)) + self.lease_seconds}
        except Exception:  # released meanwhile
            if path_exists(self.spark, self._file(name)):
                raise
            return None

    def held_by_others(self) -> set[str]:
        """Names with a claim of another owner that has not expired. There are as many as jobs have buckets in work."""
        names = [n for n in file_names(self.spark, self.path) if not n.startswith("_")]
        found = {n: self._read(n) for n in names}
        return {n for n, c in found.items() if c is not None and c["owner"] != self.owner and c["until"] > self.clock()}

    def release(self, names: Iterable[object]) -> None:
        for name in names:
            held_by = self._read(name)
            if held_by is not None and held_by["owner"] == self.owner:
                delete_path(self.spark, self._file(name))


class Failures:
    """Buckets whose load failed, one small file each, until they are loaded."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self) -> dict[str, dict]:
        """By name: ``bucket_ts``, ``path``, ``failures``, ``until`` (when the next try is due), ``error``."""
        found = {n: read_file(self.spark, f"{self.path}/{n}") for n in file_names(self.spark, self.path) if not n.startswith("_")}
        return {n: json.loads(c) for n, c in found.items()}

    def note(self, bucket_ts: int, path: str, failures: int, until: float, error: str) -> None:
        kept = {"bucket_ts": bucket_ts, "path": path, "failures": failures, "until": until, "error": error}
        self.forget([bucket_ts])
        put_file(self.spark, f"{self.path}/{bucket_ts}", json.dumps(kept).encode())

    def forget(self, buckets: Iterable[int]) -> None:
        for bucket in buckets:
            if path_exists(self.spark, f"{self.path}/{bucket}"):
                delete_path(self.spark, f"{self.path}/{bucket}")


@contextmanager
def held(spark: SparkSession, path: str, name: str, lease_seconds: int) -> Iterator[bool]:
    """A claim for one block; whether it was got."""
    claims = Claims(spark, f"{path}/_claims", lease_seconds)
    mine = claims.take(name)
    try:
        yield mine
    finally:
        if mine:
            claims.release([name])
