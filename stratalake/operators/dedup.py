"""Keep-first deduplication, stacking and first-wins merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order; NULL keys count as equal.

    `row_number() = 1` lets Catalyst put a group limit below the shuffle, so every map task
    sends at most one row per key and a hot key cannot fill one reducer.
    `dropDuplicates` would shuffle the same way but leaves open which row stays.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns that a frame lacks are NULL there."""
    return reduce(lambda top, more: top.unionByName(more, allowMissingColumns=True), frames)


def merge(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first",
) -> DataFrame:
    """Stack `new` under `old` and keep one row per key.

    `keep="first"` lets stored rows win, `keep="last"` lets the newest row win. `order` names
    columns that order the rows inside one side; it may be empty only if each side is unique.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    rows = stack_by_name([old.withColumn("_side", F.lit(0)), new.withColumn("_side", F.lit(1))])
    direction = (lambda c: F.col(c).asc()) if keep == "first" else (lambda c: F.col(c).desc())
    return keep_first(rows, keys, [direction(c) for c in ("_side", *order)]).drop("_side")


def not_yet_stored(new: DataFrame, old: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """First row per key of `new`, for keys that `old` lacks; NULL matches NULL.

    Of `old` only the key is read. Both sides meet in one shuffle, which a join after
    deduplication could not do, and repeated keys are cut down before it.
    """
    seen = old.select(key, F.lit(0).alias("_side"))
    rows = stack_by_name([new.withColumn("_side", F.lit(1)), seen])
    return keep_first(rows, [key], ["_side", *order]).filter("_side = 1").drop("_side")
