"""The location dimension over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.settings import LoadSettings

# --- fixed values: database kinds and their JDBC drivers ---
DRIVERS = {
    "oracle": "oracle.jdbc.OracleDriver",
    "postgresql": "org.postgresql.Driver",
}
# -----------------------------------------------------------


def read_location(
    spark: SparkSession,
    kind: str,
    url: str,
    table: str,
    user: str,
    password: str,
    column: str | None = None,
    connections: int = 1,
) -> DataFrame:
    """The location table. Filters and column choice on the result reach the database.

    With a whole-number ``column`` its range is asked for first and cut into as many parts as there are ``connections``, read by
    as many tasks. Rows below the least and above the greatest value belong to the outer parts, so none gets lost
    when the table changes in between; a null belongs to the first.
    """
    if kind not in DRIVERS:
        raise ValueError(f"database kind must be one of {sorted(DRIVERS)}, not {kind!r}")
    properties = {"user": user, "password": password, "driver": DRIVERS[kind]}
    if column is None or connections < 2:
        return spark.read.jdbc(url, table, properties=properties)
    ends = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) ends"
    low, high = spark.read.jdbc(url, ends, properties=properties).first()
    if low is None or int(high) - int(low) < connections:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=column, lowerBound=int(low), upperBound=int(high) + 1, numPartitions=connections, properties=properties
    )


def location_of_settings(spark: SparkSession, settings: LoadSettings) -> DataFrame:
    """The location table the settings name."""
    url = {"oracle": settings.oracle_url, "postgresql": settings.postgresql_url}.get(settings.db_kind or "")
    if not url or not settings.db_table:
        raise ValueError("db_kind, its connection string and db_table are needed to read locations")
    return read_location(
        spark, settings.db_kind, url, settings.db_table, settings.db_user, settings.db_password,
        settings.db_partition_column, settings.db_connections,
    )
