"""Delimited lines, row keys and cells as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the record formats -----------------------------------------
DELIMITER = "\t"
DATATYPE1_ARITIES = (4, 5)
DATATYPE2_ARITIES = (2, 4)
USER_KEY_SEPARATOR = "-"
CELL_FAMILY = "data"
CELL_QUALIFIER = "payload"
MAX_KEY_BYTES = 32_767
# ------------------------------------------------------------------------------


def split_fields(line: Column) -> Column:
    """Fields of a tab-delimited line, without trailing empty fields.

    ``rtrim`` of the delimiter before the split is the same as dropping the empty
    tail of the array, and both run on the JVM's single-character fast path
    (a regular expression in either place costs about twice as much).
    """
    return F.split(F.rtrim(line, F.lit(DELIMITER)), DELIMITER)


def field(fields: Column, index: int) -> Column:
    """Field by position, null when absent (``[]`` would raise under ANSI)."""
    return F.get(fields, F.lit(index))


def user_prefix(user_id: Column) -> Column:
    """Key prefix all rows of one user share; the separator ends the id."""
    return F.concat(F.reverse(user_id), F.lit(USER_KEY_SEPARATOR))


def row_key(user_id: Column, ts: Column) -> Column:
    """Row key: the id's last digits lead, so consecutive users spread over regions."""
    return F.concat(user_prefix(user_id), ts)


def has_arity(fields: Column, arities: tuple[int, ...]) -> Column:
    return F.size(fields).isin(*arities)


def key_bytes(user_id: Column, ts: Column) -> Column:
    """Size of ``row_key`` without building it."""
    return F.octet_length(user_id) + F.octet_length(F.lit(USER_KEY_SEPARATOR)) + F.octet_length(ts)


def key_fits(key: Column) -> Column:
    """Whether a row key is short enough to be stored."""
    return F.octet_length(key) <= MAX_KEY_BYTES


def cell(key: Column, qualifier: str, value: Column) -> Column:
    """The stored form of one value: row, family, qualifier and value as bytes."""
    return F.struct(
        F.encode(key, "UTF-8").alias("row"),
        F.encode(F.lit(CELL_FAMILY), "UTF-8").alias("family"),
        F.encode(F.lit(qualifier), "UTF-8").alias("qualifier"),
        F.encode(value, "UTF-8").alias("value"),
    )
