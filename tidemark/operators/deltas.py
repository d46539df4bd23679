"""Small tables that grow by a few rows at a time: one merged file, and the files added since.

Each append is one file. When there are many, they are merged into a new file that names those it covers, and which
counts from the moment that list is there. So a read opens a bounded number of files however often rows were
appended, and a merge that stops half-way changes nothing.
"""

from __future__ import annotations

import io
import time
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.operators.claims import held
from tidemark.shared import create_file, delete_path, file_names, move_path, put_file, read_file

FOLD_AFTER = 16
"""Appended files that a table has at most before they are merged, as long as its writers go on."""
LOCK_SECONDS = 600


class DeltaTable:
    """Rows of ``schema`` (DDL) below ``path``; ``merge`` reduces them when files are merged (not needed for a plain log)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame] | None = None, fold_after: int = FOLD_AFTER) -> None:
        self.spark, self.path, self.schema, self.merge, self.fold_after = spark, path, schema, merge, fold_after

    def files(self) -> list[str]:
        """Names that make up the table now: the newest merged file that is complete, and what it doesn't cover."""
        names = file_names(self.spark, self.path)
        merged = [n for n in names if n.startswith("merged-") and f"{n}.covers" in names]
        covered = set(read_file(self.spark, f"{self.path}/{merged[-1]}.covers").decode().split()) if merged else set()
        added = [n for n in names if n.startswith("delta-") and n not in covered]
        earlier = [n for n in names if n.endswith(".parquet") and n.startswith("part-") and n not in covered]
        return [*merged[-1:], *earlier, *added]

    def read(self, files: Sequence[str] | None = None) -> DataFrame:
        files = self.files() if files is None else files
        if not files:
            return self.spark.createDataFrame([], StructType.fromDDL(self.schema))
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in files])

    def rows(self) -> list[tuple]:
        """All rows on the driver, without a job: for tables that stay small."""
        out: list[tuple] = []
        for name in self.files():
            if not name.endswith(".parquet"):
                return [tuple(r) for r in self.read().collect()]
            table = pq.read_table(io.BytesIO(read_file(self.spark, f"{self.path}/{name}")))
            columns = [table.column(f.name).to_pylist() if f.name in table.column_names else [None] * len(table) for f in StructType.fromDDL(self.schema)]
            out += zip(*columns)
        return out

    def append(self, rows: Sequence[tuple] | DataFrame) -> str:
        """Add rows as one file, which becomes visible as a whole, and return its name. A driver's few rows need no job."""
        name = f"delta-{time.time_ns():020d}-{uuid.uuid4().hex}"
        if isinstance(rows, DataFrame):
            hidden = f"{self.path}/_{name}"
            rows.coalesce(1).write.parquet(hidden)
            move_path(self.spark, hidden, f"{self.path}/{name}")
        else:
            schema = to_arrow_schema(StructType.fromDDL(self.schema))
            columns = list(zip(*rows)) or [()] * len(schema)
            table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            pq.write_table(table, out := io.BytesIO())
            name += ".parquet"
            put_file(self.spark, f"{self.path}/{name}", out.getvalue())
        return name

    def fold(self, least: int | None = None) -> bool:
        """Merge the files if there are more than ``fold_after``; one writer does it at a time.

        What the merge before this one covered is removed now, so that a reader which has just listed it still finds it.
        """
        if len(self.files()) <= (self.fold_after if least is None else least):
            return False
        with held(self.spark, self.path, "_fold", LOCK_SECONDS) as mine:
            if not mine:
                return False
            before, files = file_names(self.spark, self.path), self.files()
            rows = self.read(files)
            name = f"merged-{time.time_ns():020d}-{uuid.uuid4().hex}"
            (rows if self.merge is None else self.merge(rows)).coalesce(1).write.parquet(f"{self.path}/{name}")
            stale = [n for n in before if n.startswith(("delta-", "merged-", "part-")) and n not in files and not n.endswith(".covers")]
            create_file(self.spark, f"{self.path}/{name}.covers", "\n".join([*files, *stale]).encode())
            for n in stale:
                delete_path(self.spark, f"{self.path}/{n}")
                if n.startswith("merged-"):
                    delete_path(self.spark, f"{self.path}/{n}.covers")
        return True
