"""How many rows of each stratum go to each split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv


def check_fractions(fractions: dict[str, float]) -> None:
    if set(fractions) != set(fv.SPLITS):
        raise ValueError(f"fractions must name exactly {fv.SPLITS}")
    if any(not 0.0 < value < 1.0 for value in fractions.values()):
        raise ValueError("split fractions must lie strictly between 0 and 1")
    if abs(sum(fractions.values()) - 1.0) > fv.FRACTION_SUM_TOLERANCE:
        raise ValueError(f"split fractions must sum to 1, not {sum(fractions.values()):.12g}")


def split_counts(
    df: DataFrame, stratum: str, fractions: dict[str, float] | None = None
) -> DataFrame:
    """Largest-remainder split sizes per stratum; ties go to the earlier split.

    A stratum with at least one row per split leaves no split empty while another can give.
    """
    fractions = fractions or fv.DEFAULT_FRACTIONS
    check_fractions(fractions)
    sizes = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("size"))
    exact = [F.col("size") * F.lit(fractions[name]) for name in fv.SPLITS]
    whole = [F.floor(value) for value in exact]
    left_over = [value - floor for value, floor in zip(exact, whole, strict=True)]
    missing = F.col("size") - sum(whole[1:], whole[0])
    counts = []
    for i, floor in enumerate(whole):
        ahead = F.lit(0)
        for j in range(len(whole)):
            if j != i:
                first = left_over[j] >= left_over[i] if j < i else left_over[j] > left_over[i]
                ahead = ahead + first.cast("int")
        counts.append((floor + (ahead < missing).cast("long")).alias(fv.SPLITS[i]))
    allotted = sizes.select(stratum, "size", *counts)
    for name in fv.SPLITS:
        allotted = _fill_empty(allotted, name)
    return allotted


def _fill_empty(allotted: DataFrame, empty: str) -> DataFrame:
    largest = F.greatest(*fv.SPLITS)
    donor: Column = F.lit(None).cast("string")
    for name in reversed(fv.SPLITS):
        donor = F.when(F.col(name) == largest, F.lit(name)).otherwise(donor)
    moves = (F.col("size") >= len(fv.SPLITS)) & (F.col(empty) == 0) & (largest > 1)
    marked = allotted.withColumn("__donor", F.when(moves, donor))
    shifted = {
        name: F.col(name)
        + (F.col("__donor").isNotNull() & F.lit(name == empty)).cast("long")
        - F.coalesce((F.col("__donor") == name).cast("long"), F.lit(0))
        for name in fv.SPLITS
    }
    return marked.withColumns(shifted).drop("__donor")
