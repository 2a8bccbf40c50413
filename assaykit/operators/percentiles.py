"""Exact percentiles by a sketch and distributed selection, with no group held in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.session import durable

# Rank error of the sketch is at most n / ACCURACY; the search range is three times as wide.
ACCURACY = 10_000
SMALL_GROUP = ACCURACY
#: Most records of one ordered window. A bracket that can hold more is cut into SLICES slices by
#: value, of which only the one with the wanted rank is looked at further.
SLICE_ROWS = 1_000_000
SLICES = 4_096
#: Groups times quantiles that are broadcast to the values.
BROADCAST_ROWS = 1_000_000


def exact_percentiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    method: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per group: count, mean and the named quantiles of the non-null values.

    ``method`` is ``linear`` (interpolation at (n-1)q) or ``nearest`` (rank ceil(q*n)).
    Pass 1 brackets each quantile with a mergeable sketch; pass 2 counts what lies below the
    bracket and keeps the distinct values inside it, at most 8 in 10,000 of a large group's rows.
    If these can be more than ``slice_rows``, slices of them are counted first, until the slice
    that holds the wanted rank is small (``_selected``). So no task orders more than ``slice_rows``
    values of a group. The brackets, one record per group and quantile, are broadcast if they are
    few; the distinct values are neither broadcast nor gathered by group.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"unknown percentile method {method!r}")
    # An empty grouping becomes one constant column.
    named = {f"__g{i}": F.col(c) for i, c in enumerate(group)} or {"__g0": F.lit(0)}
    keys = list(named)
    values = df.where(F.col(value).isNotNull()).select(
        *[column.alias(key) for key, column in named.items()],
        F.col(value).cast("double").alias("__v"),
    )
    margin = 3.0 / ACCURACY
    probes = [
        p for q in quantiles.values() for p in (max(q - margin, 0.0), min(q + margin, 1.0))
    ]
    sketched = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.avg("__v").alias("__mean"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
        F.percentile_approx("__v", probes, ACCURACY).alias("__probes"),
    )
    brackets = []
    for i, (name, q) in enumerate(quantiles.items()):
        small = F.col("__n") <= SMALL_GROUP
        n = F.col("__n").cast("double")
        if method == "linear":
            spot = (n - 1) * F.lit(q)
            low_rank, high_rank = F.floor(spot) + 1, F.ceil(spot) + 1
            weight = spot - F.floor(spot)
        else:
            low_rank = high_rank = F.greatest(F.lit(1), F.ceil(n * F.lit(q)))
            weight = F.lit(0.0)
        open_low, open_high = q - margin <= 0.0, q + margin >= 1.0
        brackets.append(
            F.struct(
                F.lit(name).alias("name"),
                (F.col("__min") if open_low else F.when(small, F.col("__min"))
                 .otherwise(F.col("__probes")[2 * i])).alias("low"),
                (F.col("__max") if open_high else F.when(small, F.col("__max"))
                 .otherwise(F.col("__probes")[2 * i + 1])).alias("high"),
                low_rank.cast("long").alias("low_rank"),
                high_rank.cast("long").alias("high_rank"),
                weight.cast("double").alias("weight"),
            )
        )
    facts = [*keys, "__n", "__mean"]
    plan = sketched.select(*facts, F.explode(F.array(*brackets)).alias("b")).select(*facts, "b.*")
    plan = durable(plan)
    records, largest = plan.agg(F.count(F.lit(1)), F.max("__n")).first()
    if records <= BROADCAST_ROWS:  # the values, on the other side, then stay where they are
        plan = F.broadcast(plan)

    # Distinct values first: a value shared by a third of the rows becomes one record.
    distinct = values.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    placed = distinct.join(plan, keys).where(F.col("__v") <= F.col("high"))
    inside = F.col("__v") >= F.col("low")
    # Everything below the bracket collapses into one record per group and quantile.
    compact = placed.groupBy(
        *facts, "name", "low_rank", "high_rank", "weight",
        F.when(inside, F.col("__v")).alias("__v"),
    ).agg(F.sum("__c").alias("__c"))
    parts = [*facts, "name", "weight", "low_rank", "high_rank"]
    if max(SMALL_GROUP, (largest or 0) * 8 // ACCURACY) <= slice_rows:
        ends = _ranked(compact, parts, keys)
    else:
        ends = _selected(compact, parts, keys, slice_rows, records <= BROADCAST_ROWS)
    # The sketch's error bound makes this certain; should it ever not hold, fail, do not guess.
    bracketed = (F.coalesce("below", F.lit(0)) < F.col("low_rank")) & (
        F.col("reached") >= F.col("high_rank")
    )
    answer = F.when(
        bracketed, F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")
    ).otherwise(F.raise_error(F.lit("percentile outside its bracket")).cast("double"))
    return ends.groupBy(*facts).agg(
        *[F.max(F.when(F.col("name") == name, answer)).alias(name) for name in quantiles]
    ).select(
        *[F.col(k).alias(c) for k, c in zip(keys, group, strict=False)],
        F.col("__n").alias("count"),
        F.col("__mean").alias("mean"),
        *quantiles,
    )


def _ranked(compact: DataFrame, facts: list[str], keys: list[str]) -> DataFrame:
    """Values at the two ranks of each bracket, by a window over the bracket."""
    running = (
        Window.partitionBy(*keys, "name")
        .orderBy(F.asc_nulls_first("__v"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = compact.withColumn("__upto", F.sum("__c").over(running))
    return upto.groupBy(*facts).agg(
        F.min(F.when(F.col("__upto") >= F.col("low_rank"), F.col("__v"))).alias("low"),
        F.min(F.when(F.col("__upto") >= F.col("high_rank"), F.col("__v"))).alias("high"),
        F.max(F.when(F.col("__v").isNull(), F.col("__upto"))).alias("below"),
        F.max("__upto").alias("reached"),
    )


def _selected(
    compact: DataFrame, facts: list[str], keys: list[str], slice_rows: int, few: bool
) -> DataFrame:
    """The same by selection: count slices of the bracket, go on in the one that holds the rank.

    Slices are even in the bits of a double, which are ordered like the doubles. A round cuts the
    range of bits by ``SLICES``, so six rounds reach a single value whatever the distribution.
    """
    bits = F.expr("CAST(java_method('java.lang.Double', 'doubleToLongBits', __v + 0.0D) AS BIGINT)")
    ordered = F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)
    compact = durable(compact.withColumn("__k", F.when(F.col("__v").isNotNull(), ordered)))
    known = compact.groupBy(*facts).agg(
        F.sum(F.when(F.col("__v").isNull(), F.col("__c"))).alias("below"),
        F.sum("__c").alias("reached"),
        F.min("__k").alias("__low"),
        F.max("__k").alias("__high"),
    )
    known = durable(known)
    each = F.explode(
        F.array(
            F.struct(F.lit("low").alias("end"), F.col("low_rank").alias("rank")),
            F.struct(F.lit("high").alias("end"), F.col("high_rank").alias("rank")),
        )
    )
    targets = known.select(*keys, "name", "below", "__low", "__high", each.alias("t")).select(
        *keys, "name", "t.end", (F.col("t.rank") - F.coalesce("below", F.lit(0))).alias("rank"),
        "__low", "__high",
    )
    of_target = [*keys, "name", "end"]

    def chosen() -> DataFrame:
        side = F.broadcast(targets) if few else targets
        inside = (F.col("__k") >= F.col("__low")) & (F.col("__k") <= F.col("__high"))
        return values.join(side, [*keys, "name"]).where(inside)

    values = compact.where("__k IS NOT NULL").select(*keys, "name", "__k", "__v", "__c")
    while True:
        most = chosen().groupBy(*of_target).count()
        if (most.agg(F.max("count")).first()[0] or 0) <= slice_rows:
            break
        far, near = (F.col(c).cast("decimal(20,0)") for c in ("__high", "__low"))
        share = (F.col("__k").cast("decimal(20,0)") - near).cast("double") / ((far - near).cast("double") + 1.0)
        slice_of = F.floor(share * SLICES).cast("int")
        slices = chosen().groupBy(*of_target, "rank", slice_of.alias("slice")).agg(
            F.sum("__c").alias("c"), F.min("__k").alias("__low"), F.max("__k").alias("__high")
        )
        along = Window.partitionBy(*of_target).orderBy("slice")
        upto = F.sum("c").over(along)
        found = slices.withColumn("upto", upto).where(
            (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank"))
        )
        targets = durable(
            found.select(
                *of_target, (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), "__low", "__high"
            )
        )
    running = (
        Window.partitionBy(*of_target).orderBy("__k")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = chosen().withColumn("__upto", F.sum("__c").over(running)).where(F.col("__upto") >= F.col("rank"))
    last = last.groupBy(*keys, "name").agg(
        *[F.min_by("__v", F.when(F.col("end") == end, F.col("__k"))).alias(end) for end in ("low", "high")]
    )
    return known.drop("__low", "__high").join(last, [*keys, "name"], "left")
