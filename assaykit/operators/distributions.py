"""Label counts, balance and coverage audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv


def label_distribution(
    rows: DataFrame, dimensions: dict[str, Column], group: Sequence[str] = ()
) -> DataFrame:
    """(group, dimension, label, rows) counts, all dimensions in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), label.cast("string").alias("label"))
            for name, label in dimensions.items()
        ]
    )
    return (
        rows.select(*group, F.explode(pairs).alias("x"))
        .groupBy(*group, "x.dimension", "x.label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def grid_balance(rows: DataFrame, dimensions: Sequence[str], variant: str) -> DataFrame:
    """Rows and distinct variants per cell of the label grid and per single label.

    Counting (cell, variant) first keeps every group at one record per variant.
    """
    base = rows.groupBy(*dimensions, variant).agg(F.count(F.lit(1)).alias("__n"))
    cells = base.groupBy(*dimensions).agg(
        F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("variants")
    )
    full = cells.select(
        F.lit("cell").alias("level"),
        F.concat_ws("/", *[F.col(d).cast("string") for d in dimensions]).alias("label"),
        "rows",
        "variants",
    )
    singles = None
    for d in dimensions:
        one = (
            base.groupBy(d, variant)
            .agg(F.sum("__n").alias("__n"))
            .groupBy(d)
            .agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("variants"))
            .select(
                F.lit(d).alias("level"), F.col(d).cast("string").alias("label"), "rows", "variants"
            )
        )
        singles = one if singles is None else singles.unionByName(one)
    return full.unionByName(singles)


def balance_summary(balance: DataFrame) -> DataFrame:
    """Cells, and the smallest and largest number of rows and variants, per level."""
    return balance.groupBy("level").agg(
        F.count(F.lit(1)).alias("labels"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.min("variants").alias("min_variants"),
        F.max("variants").alias("max_variants"),
    )


def placeholder_counts(rows: DataFrame, placeholders: Column) -> DataFrame:
    return (
        rows.select(F.explode(placeholders).alias("placeholder"))
        .groupBy("placeholder")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def distinct_values(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(column, rows, distinct) for several columns.

    Each (column, value) pair is a group of its own, so a frequent value is combined map-side
    and no distinct set is built in one task.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"))
            for name, value in columns.items()
        ]
    )
    counted = (
        rows.select(F.explode(pairs).alias("x"))
        .groupBy("x.column", "x.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("column").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct")
    )


def holdout_coverage(
    rows: DataFrame,
    split: str,
    dimensions: dict[str, Sequence[str]],
    even_dimension: str | None = "priority",
    holdouts: Sequence[str] = ("validation", "test"),
) -> DataFrame:
    """(split, dimension, feasible, missing_labels, label_range, passed) per holdout.

    A dimension is checked only where it can be met: the source holds exactly the given labels,
    each at least once per holdout, and every holdout has at least as many rows as labels.
    """
    named = rows.withColumn("split", F.col(split))
    counts = label_distribution(named, {name: F.col(name) for name in dimensions}, ["split"])
    known = F.lit(None).cast("array<string>")
    for name, labels in dimensions.items():
        array = F.array(*[F.lit(str(label)) for label in labels])
        known = F.when(F.col("dimension") == name, array).otherwise(known)
    counts = counts.withColumn("known", F.array_contains(known, F.col("label")))
    per_label = counts.groupBy("dimension", "label", "known").agg(
        F.sum("rows").alias("source"),
        *[
            F.coalesce(F.sum(F.when(F.col("split") == h, F.col("rows"))), F.lit(0)).alias(h)
            for h in holdouts
        ],
    )
    size = F.size(known)
    totals = per_label.groupBy("dimension").agg(
        F.count_if("known").alias("known_seen"),
        F.count_if(~F.col("known")).alias("unknown_seen"),
        F.min("source").alias("least"),
        *[F.sum(h).alias(f"{h}_rows") for h in holdouts],
        *[F.count_if(F.col("known") & (F.col(h) > 0)).alias(f"{h}_labels") for h in holdouts],
        *[F.max(F.when(F.col("known"), F.col(h))).alias(f"{h}_max") for h in holdouts],
        *[F.min(F.when(F.col("known"), F.col(h))).alias(f"{h}_min") for h in holdouts],
    )
    enough = F.lit(True)
    for h in holdouts:
        enough = enough & (F.col(f"{h}_rows") >= size)
    feasible = (
        (F.col("known_seen") == size)
        & (F.col("unknown_seen") == 0)
        & (F.col("least") >= len(holdouts))
        & enough
    )
    return totals.select(
        "dimension",
        feasible.alias("feasible"),
        size.alias("labels"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(h).alias("split"),
                        (size - F.col(f"{h}_labels")).alias("missing_labels"),
                        F.when(
                            F.col("known_seen") == size, F.col(f"{h}_max") - F.col(f"{h}_min")
                        ).otherwise(F.col(f"{h}_max")).alias("label_range"),
                    )
                    for h in holdouts
                ]
            )
        ).alias("h"),
    ).select(
        "h.split",
        "dimension",
        "feasible",
        F.col("h.missing_labels").cast("long").alias("missing_labels"),
        F.coalesce("h.label_range", F.lit(0)).cast("long").alias("label_range"),
        (
            ~F.col("feasible")
            | (
                (F.col("h.missing_labels") == 0)
                & ((F.col("dimension") != F.lit(even_dimension or "")) | (F.col("h.label_range") <= 1))
            )
        ).alias("passed"),
    )


def split_inventory_problems(inventory: DataFrame, declared: DataFrame, total: int | Column) -> DataFrame:
    """Manifest consistency: per-split counts, empty or repeated ids, overlap, and the total.

    ``inventory`` has (split, id) rows, ``declared`` has (split, rows).
    """
    counted = inventory.groupBy("split").agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(F.trim("id") == "").alias("blank")
    )
    sides = declared.join(counted, "split", "full_outer").select(
        "split",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.col("rows").eqNullSafe(F.col("listed")), F.lit("count differs")),
                    F.when(F.col("blank") > 0, F.lit("blank id")),
                    F.when(~F.coalesce(F.col("split").isin(*fv.SPLITS), F.lit(False)),
                           F.lit("unknown split")),
                )
            )
        ).alias("problem"),
    )
    pairs = inventory.groupBy("id", "split").agg(F.count(F.lit(1)).alias("n"))
    per_id = pairs.groupBy("id").agg(
        F.max("n").alias("most"), F.count(F.lit(1)).alias("sets"), F.min("split").alias("split")
    )
    repeated = per_id.where("most > 1").select("split", F.lit("repeated id").alias("problem"))
    overlap = per_id.where("sets > 1").select("split", F.lit("id in two splits").alias("problem"))
    whole = declared.agg(F.sum("rows").alias("rows")).where(
        ~F.col("rows").eqNullSafe(F.lit(total) if isinstance(total, int) else total)
    ).select(F.lit("").alias("split"), F.lit("total differs").alias("problem"))
    return (
        sides.unionByName(repeated).unionByName(overlap).unionByName(whole)
        .groupBy("split", "problem").agg(F.count(F.lit(1)).alias("cases"))
    )


def length_budget(
    rows: DataFrame, full: str, prompt: str, limit: int, group: Sequence[str] = ()
) -> DataFrame:
    """Length audit over rows of (full length, prompt length): extremes and failing rows."""
    completion = F.col(full) - F.col(prompt)
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("examples"),
        F.max(full).alias("max_full_tokens"),
        F.min(completion).alias("min_completion_tokens"),
        F.count_if(F.col(full) > limit).alias("over_limit"),
        F.count_if(completion <= 0).alias("without_completion"),
    )


def length_violations(rows: DataFrame, row_id: str, full: str, prompt: str, limit: int) -> DataFrame:
    completion = F.col(full) - F.col(prompt)
    problem = F.when(F.col(full) > limit, "over limit").when(completion <= 0, "no completion")
    return rows.select(row_id, full, prompt, problem.alias("problem")).where(
        F.col("problem").isNotNull()
    )
