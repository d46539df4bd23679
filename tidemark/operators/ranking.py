"""Position of each row in a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.enrich import small_enough
from tidemark.operators.layout import by_key_range
from tidemark.shared import shared_folder

_PARTITION_BITS = 33
"""``monotonically_increasing_id`` keeps the row number in its lower 33 bits."""


def with_position(
    rows: DataFrame, order: list[str], within: list[str] | None = None, copies: bool = False
) -> DataFrame:
    """Add ``position``: 1, 2, ... in ``order``, counted anew for each ``within`` group.

    The rows are range-shuffled into their order and checkpointed, because a range
    shuffle computed twice may cut elsewhere. What a row then lacks is how many rows
    its group has in earlier partitions, and where its group starts in its own. Both
    come from one count per (partition, group). Groups are contiguous in the order,
    so there are at most partitions + groups counts. ``copies`` is for row-grain input
    in which a group of equal rows may be large (see ``by_key_range``).
    """
    within = within or []
    shared_folder(rows.sparkSession)
    ordered = by_key_range(rows, *within, *order, copies=copies)
    placed = ordered.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftrightunsigned("_at", _PARTITION_BITS).alias("_part")
    counts = placed.groupBy(part, *within).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first")
    )
    if within:
        earlier = Window.partitionBy(*within).orderBy("_part")
    else:
        # one count per shuffle partition: a size the session sets, not the data
        earlier = Window.orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        *[F.col(c).alias(f"_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # without groups there is one count per partition; else the counts are measured
    if not within or small_enough(starts):
        starts = F.broadcast(starts)
    same = F.shiftrightunsigned("_at", _PARTITION_BITS) == starts["_part"]
    for name in within:
        same = same & placed[name].eqNullSafe(starts[f"_{name}"])
    return placed.join(starts, same).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("position")
    )
