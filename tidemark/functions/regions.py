"""Split keys and region lookup.

A region is the half-open key range between two neighbouring start keys. Region 0
is everything below the first start key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAX_TREE_BOUNDS = 127
"""Largest comparison tree that stays inside one JIT-compiled method."""

KEY_CEILING = "\U0010ffff"
"""Sorts after every continuation of a key prefix."""


def split_keys(regions: Column) -> Column:
    """Array of the ``n - 1`` evenly spaced, zero-padded split keys for ``n`` regions.

    The quotient is kept in 32-bit precision: a wider one rounds some keys differently.
    """
    n = regions.cast("bigint")
    padded = F.ceil(F.log10(n)) + F.lit(1)
    digits = F.when(n % 10 == 0, padded - 1).otherwise(padded).cast("int")

    def key(i: Column) -> Column:
        share = (i.cast("float") / n.cast("float")).cast("float")
        scaled = F.floor(share * F.pow(F.lit(10.0), digits) + F.lit(0.5))
        return F.lpad(scaled.cast("bigint").cast("string"), digits, F.lit("0"))

    return F.when(n > 1, F.transform(F.sequence(F.lit(1).cast("bigint"), n - 1), key)).otherwise(
        F.array().cast("array<string>")
    )


def split_key_list(spark: SparkSession, regions: int) -> list[str]:
    """The split keys as Python text, for use as literals in a plan (``n - 1`` values)."""
    return spark.range(1).select(split_keys(F.lit(regions)).alias("keys")).first()["keys"]


def region_of(key: str, bounds: Sequence[str]) -> Column:
    """Number of start keys that are not above column ``key``; ``bounds`` is sorted and distinct.

    Up to ``MAX_TREE_BOUNDS`` bounds become a balanced comparison tree: seven string
    comparisons for 100 regions, all inside whole-stage codegen. Beyond that a tree
    picks a run of bounds and a binary search over the literal array finishes in it.
    """
    bounds = list(bounds)
    if any(a >= b for a, b in zip(bounds, bounds[1:])):
        raise ValueError("region bounds must be sorted and distinct")
    name = "`" + key.replace("`", "``") + "`"
    if len(bounds) <= MAX_TREE_BOUNDS:
        return F.expr(_tree(name, bounds, list(range(len(bounds) + 1))))
    run = -(-len(bounds) // MAX_TREE_BOUNDS)
    start = _tree(name, bounds[run - 1 :: run], list(range(0, len(bounds) + 1, run)))
    array = f"array({', '.join(map(_literal, bounds))})"
    steps = ", ".join(str(1 << i) for i in reversed(range(run.bit_length())))
    return F.expr(
        f"aggregate(array({steps}), {start}, (count, step) -> if("
        f"count + step <= {len(bounds)} and get({array}, count + step - 1) <= {name}, "
        "count + step, count))"
    )


def _literal(text: str) -> str:
    if text.isascii() and text.isalnum():
        return f"'{text}'"
    return f"cast(X'{text.encode().hex()}' as string)"


def _tree(name: str, bounds: list[str], counts: list[int]) -> str:
    """SQL for the value of ``counts`` at the gap between ``bounds`` that ``name`` falls
    into. Built as text: one parse is much cheaper than a call per comparison."""
    if not bounds:
        return str(counts[0])
    mid = len(bounds) // 2
    below = _tree(name, bounds[:mid], counts[: mid + 1])
    above = _tree(name, bounds[mid + 1 :], counts[mid + 1 :])
    return f"if({name} < {_literal(bounds[mid])}, {below}, {above})"


def region_of_key(key: str, bounds: Sequence[str]) -> int:
    """Region of one known key, for pruning a read."""
    return bisect_right(list(bounds), key)


def region_interval(prefix: str, bounds: Sequence[str]) -> tuple[int, int]:
    """First and last region that can hold keys starting with ``prefix``."""
    return region_of_key(prefix, bounds), region_of_key(prefix + KEY_CEILING, bounds)
