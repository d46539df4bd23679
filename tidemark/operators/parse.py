"""Lines to records: split, filter, key, cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fields as X
from tidemark.functions import payload as J


def with_fields(lines: DataFrame, line: str = "value", fields: str = "fields") -> DataFrame:
    """Add the field array of each line.

    The array goes through ``explode`` of a one-element array. A generator is a
    boundary the optimizer does not push a filter through, so the split runs once
    per line; as a plain column it would be computed in the arity filter and again
    in the projection above it.
    """
    split = F.explode(F.array(X.split_fields(F.col(line)))).alias(fields)
    return lines.select("*", split)


def keep_datatype1(records: DataFrame, fields: str = "fields") -> DataFrame:
    return records.where(X.has_arity(F.col(fields), X.DATATYPE1_ARITIES))


def keep_datatype2(records: DataFrame, fields: str = "fields") -> DataFrame:
    return records.where(X.has_arity(F.col(fields), X.DATATYPE2_ARITIES))


def keep_storable_keys(keyed: DataFrame, key: str = "userid_ts") -> DataFrame:
    return keyed.where(X.key_fits(F.col(key)))


def keyed_payloads(records: DataFrame, fields: str = "fields", carry: tuple[str, ...] = ()) -> DataFrame:
    """Row key and payload of datatype1 records; nothing else travels to the shuffle."""
    f = F.col(fields)
    return records.select(
        *carry,
        X.row_key(X.field(f, 1), X.field(f, 0)).alias("userid_ts"),
        X.field(f, 3).alias("payload"),
    )


def parse_datatype1(lines: DataFrame, line: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Lines to (``carry``, ``userid_ts``, ``payload``)."""
    records = keep_datatype1(with_fields(lines.select(*carry, line), line))
    return keep_storable_keys(keyed_payloads(records, carry=carry))


def parse_datatype2(lines: DataFrame, line: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Lines to (``carry``, ``fields``); positions keep their order and have no names."""
    return keep_datatype2(with_fields(lines.select(*carry, line), line)).select(*carry, "fields")


def cells(keyed: DataFrame, qualifiers: tuple[str, ...] = (X.CELL_QUALIFIER,)) -> DataFrame:
    """Cell form of keyed rows: four binary columns, one row per value that is not null."""
    made = [X.cell(F.col("userid_ts"), name, F.col(name)) for name in qualifiers]
    long = keyed.select(F.explode(F.array(*made)) if len(made) > 1 else made[0])
    return long.toDF("cell").select("cell.*").where(F.col("value").isNotNull())


def keep_present(records: DataFrame, value: str) -> DataFrame:
    """Rows whose getter value is not empty; the malformed mark passes."""
    return records.where(F.col(value) != J.MISSING)


def keep_valid_json(records: DataFrame, payload: str = "payload") -> DataFrame:
    return records.where(J.is_valid_json(F.col(payload)))
