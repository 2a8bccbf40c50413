"""Positions in a digest order, without one task seeing a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_by_digest(
    df: DataFrame,
    group: Sequence[str],
    key: str,
    out: str = "position",
    prefix_hex: int = 3,
) -> DataFrame:
    """Add the 0-based rank of ``key`` (hex digest) inside each group.

    Digests are uniform, so their leading hex digits cut any group, however large, into even
    slices that are already in order. Rows are ranked inside their slice; the counts of the
    slices before it are added. ``prefix_hex`` = 3 gives 4,096 slices per group.
    """
    return rank_levels(df, {out: tuple(group)}, key, prefix_hex)


def rank_levels(
    df: DataFrame,
    levels: dict[str, tuple[str, ...]],
    key: str,
    prefix_hex: int = 3,
) -> DataFrame:
    """Add several ranks at once, each inside its own group columns.

    The first level's columns must be contained in every other level's, so that one shuffle
    by (first level, slice) serves all of them.
    """
    everything = tuple(dict.fromkeys(c for columns in levels.values() for c in columns))
    # A digest is never null; saying so keeps the join from filtering on it (and hashing twice).
    number = F.conv(F.substring(key, 1, prefix_hex), 16, 10).cast("int")
    sliced = df.withColumn("__slice", F.coalesce(number, F.lit(0)))
    counts = sliced.groupBy(*everything, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    ranked, offsets = sliced, counts
    for out, columns in levels.items():
        inside = Window.partitionBy(*columns, "__slice").orderBy(key)
        before = (
            Window.partitionBy(*columns)
            .orderBy("__slice")
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        ranked = ranked.withColumn(out, F.row_number().over(inside) - 1)
        offsets = offsets.withColumn(
            f"__before_{out}", F.coalesce(F.sum("__n").over(before), F.lit(0))
        )
    ranked = ranked.join(offsets.drop("__n"), [*everything, "__slice"])
    for out in levels:
        ranked = ranked.withColumn(out, F.col(out) + F.col(f"__before_{out}"))
    return ranked.drop("__slice", *[f"__before_{out}" for out in levels])


def slot_of(position: Column, width: int) -> Column:
    """Fixed-size bucket of a position."""
    return F.floor(position / F.lit(width)).cast("long")
