"""First-seen rows per key, duplicates, and keys shared across sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# With the 1,024 largest groups set apart, no other group can hold more than 1/1024 of the rows.
HEAVY_GROUPS = 1024


def lookup_by_group(
    rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner"
) -> DataFrame:
    """Join rows to one record per key when a few keys may own most of the rows.

    The heaviest groups, at most ``HEAVY_GROUPS`` records, are broadcast, so their rows stay
    where they are. All other keys meet in a shuffle whose groups are small by construction.
    """
    heavy = groups.orderBy(F.desc(size), F.asc(key)).limit(HEAVY_GROUPS)
    hot = rows.join(F.broadcast(heavy), key, "inner")
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return hot.unionByName(rest.join(groups, key, how))


def first_seen(
    rows: DataFrame, key: str, order: Sequence[str], only_repeated: bool = True
) -> DataFrame:
    """One record per key: the smallest ``order`` tuple (``first``) and the group size (``copies``).

    ``min`` combines on the map side, so a hot key costs one record per task. A single order
    column is aggregated as it is, because numbers can be combined in place.
    """
    if len(order) == 1:
        least = F.struct(F.min(order[0]).alias(order[0]))
    else:
        least = F.min(F.struct(*order))
    groups = rows.groupBy(key).agg(least.alias("first"), F.count(F.lit(1)).alias("copies"))
    return groups.where(F.col("copies") > 1) if only_repeated else groups


def repeated_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows that come after the first one of their key, with that first row and the group size."""
    groups = first_seen(rows, key, order)
    joined = lookup_by_group(rows, groups, key, "copies")
    return joined.where(F.struct(*order) > F.col("first"))


def shared_across(rows: DataFrame, key: str, member: str) -> DataFrame:
    """Keys that occur in more than one set, e.g. one fingerprint in two splits.

    Counting (key, set) pairs first leaves at most one record per set and key.
    """
    pairs = rows.groupBy(key, member).agg(F.count(F.lit(1)).alias("rows"))
    return (
        pairs.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("sets"),
            F.sum("rows").alias("rows"),
            F.min(member).alias("first_set"),
            F.max(member).alias("last_set"),
        )
        .where(F.col("sets") > 1)
    )


def found_in(rows: DataFrame, reference: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) in the reference set.

    Reference keys are made distinct first. Hot keys of ``rows`` are split by AQE skew handling,
    and a distinct right side has one record per key, so copies on that side stay cheap.
    """
    return rows.join(reference.select(key).distinct(), key, how)


def keys_complete(observed: DataFrame, expected: Sequence[str], name: str) -> DataFrame:
    """Compare a set of names with the expected one: missing, unexpected and repeated names."""
    wanted = observed.sparkSession.createDataFrame([(value,) for value in expected], f"{name} string")
    counted = observed.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    both = counted.join(F.broadcast(wanted.withColumn("wanted", F.lit(True))), name, "full_outer")
    problem: Column = (
        F.when(F.col("n").isNull(), "missing")
        .when(F.col("wanted").isNull(), "unexpected")
        .when(F.col("n") > 1, "repeated")
    )
    return both.select(name, problem.alias("problem")).where(F.col("problem").isNotNull())
