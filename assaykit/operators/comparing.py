"""Comparison of two scored runs over the same cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.operators.scoring import metric_rows, summarize


def pair_runs(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Full outer pairing of two tables with one row per key: ``l_*``, ``r_*``, ``in_l``, ``in_r``."""
    renamed = [
        side.select(key, *[F.col(c).alias(f"{p}_{c}") for c in columns], F.lit(True).alias(f"in_{p}"))
        for p, side in (("l", left), ("r", right))
    ]
    return renamed[0].join(renamed[1], key, "full_outer").withColumns(
        {f"in_{p}": F.coalesce(f"in_{p}", F.lit(False)) for p in ("l", "r")}
    )


def cohort_problems(
    candidate: DataFrame,
    baseline: DataFrame,
    key: str = "id",
    position: str = "position",
    expected: Sequence[str] = (),
    identity: Sequence[str] = (),
) -> DataFrame:
    """(problem, id) rows; two runs are comparable when there are none.

    Checked are repeated ids, ids missing on a side, different positions, different expected
    values, and different values of the ``identity`` columns (model, revision, lineage). Each side is reduced to its first row per id before the join, so an id
    repeated on both sides does not multiply.
    """
    columns = [position, *expected, *identity]
    sides = [
        side.groupBy(key)
        .agg(F.min(F.struct(*columns)).alias("row"), F.count(F.lit(1)).alias("copies"))
        .select(key, "row.*", "copies")
        for side in (candidate, baseline)
    ]
    pairs = pair_runs(*sides, key, [*columns, "copies"])
    both = F.col("in_l") & F.col("in_r")
    differs = F.lit(False)
    for name in expected:
        differs = differs | ~F.col(f"l_{name}").eqNullSafe(F.col(f"r_{name}"))
    problems: list[tuple[str, Column]] = [
        ("missing from candidate", ~F.col("in_l")),
        ("missing from baseline", ~F.col("in_r")),
        ("position differs", both & (F.col(f"l_{position}") != F.col(f"r_{position}"))),
        ("expected output differs", both & differs),
        ("repeated in candidate", F.coalesce(F.col("l_copies") > 1, F.lit(False))),
        ("repeated in baseline", F.coalesce(F.col("r_copies") > 1, F.lit(False))),
    ]
    for name in identity:
        unequal = ~F.col(f"l_{name}").eqNullSafe(F.col(f"r_{name}"))
        problems.append((f"{name} differs", both & unequal))
    return pairs.select(
        F.explode(
            F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in problems]))
        ).alias("problem"),
        key,
    )


def heldout_problems(
    predictions: DataFrame, heldout: DataFrame, manifest_sha256: str, split_sha256: str
) -> DataFrame:
    """(problem, id): where predictions are not bound to the verified held-out rows; J5.

    Both have id, position and expected. Every prediction has to name the manifest and the split,
    and where it names the digests its model was trained with, the same test split. A column that
    the predictions lack counts as a value they lack.
    """
    lineage = {
        "dataset_manifest_sha256": "string", "dataset_split_sha256": "string",
        "training_dataset_sha256": "map<string,string>",
    }
    lacking = {c: F.lit(None).cast(t) for c, t in lineage.items() if c not in predictions.columns}
    rows = predictions.withColumns(lacking)
    trained = F.col("training_dataset_sha256")
    wrong = [
        ("manifest digest differs", ~F.col("dataset_manifest_sha256").eqNullSafe(F.lit(manifest_sha256))),
        ("split digest differs", ~F.col("dataset_split_sha256").eqNullSafe(F.lit(split_sha256))),
        ("training test digest differs",
         (F.size(trained) > 0) & ~F.element_at(trained, "test").eqNullSafe(F.lit(split_sha256))),
    ]
    named = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in wrong]))
    own = rows.select(F.explode(named).alias("problem"), "id")
    renamed = F.regexp_replace(F.regexp_replace("problem", "candidate", "predictions"), "baseline", "held-out rows")
    both = cohort_problems(predictions, heldout, expected=["expected"])
    return both.select(renamed.alias("problem"), "id").unionByName(own)


def provenance_problems(
    candidate: DataFrame,
    baseline: DataFrame,
    same: Sequence[str],
    absent_in_baseline: Sequence[str],
) -> DataFrame:
    """Header-level guard over two one-row provenance tables."""
    both = candidate.select(*[F.col(c).alias(f"l_{c}") for c in same]).withColumn("k", F.lit(1)).join(
        baseline.select(
            *[F.col(c).alias(f"r_{c}") for c in same],
            *[F.col(c).isNotNull().alias(f"has_{c}") for c in absent_in_baseline],
        ).withColumn("k", F.lit(1)),
        "k",
        "full_outer",
    )
    checks = [F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), F.lit(f"{c} differs")) for c in same]
    checks += [
        F.when(F.col(f"has_{c}"), F.lit(f"baseline declares {c}")) for c in absent_in_baseline
    ]
    return both.select(F.explode(F.array_compact(F.array(*checks))).alias("problem"))


def metric_deltas(
    candidate: DataFrame, baseline: DataFrame, metrics: Sequence[str] = fv.NON_REGRESSION_METRICS
) -> DataFrame:
    """(metric, candidate, baseline, delta, passed): no metric may fall."""
    left = metric_rows(candidate, metrics).withColumnRenamed("value", "candidate")
    right = metric_rows(baseline, metrics).withColumnRenamed("value", "baseline")
    return left.join(right, "metric").select(
        "metric",
        "candidate",
        "baseline",
        (F.col("candidate") - F.col("baseline")).alias("delta"),
        (F.col("candidate") - F.col("baseline") >= 0.0).alias("passed"),
    )


def compare_runs(candidate_scores: DataFrame, baseline_scores: DataFrame) -> DataFrame:
    """Metric deltas of two scored runs. Both are summarised in one pass over their union."""
    wanted = ["expected", *[c for c in candidate_scores.columns if c.endswith("_correct")],
              "predicted_category", "predicted_priority", "predicted_sentiment",
              "strict_json_only", "schema_valid", "field_completeness",
              "response_policy_compliant", "exact_match"]
    both = candidate_scores.select(F.lit("candidate").alias("run"), *wanted).unionByName(
        baseline_scores.select(F.lit("baseline").alias("run"), *wanted)
    )
    values = metric_rows(
        summarize(both, ["run"], latency=False), fv.NON_REGRESSION_METRICS, ["run"]
    )
    side = values.groupBy("metric").agg(
        F.max(F.when(F.col("run") == "candidate", F.col("value"))).alias("candidate"),
        F.max(F.when(F.col("run") == "baseline", F.col("value"))).alias("baseline"),
    )
    delta = F.col("candidate") - F.col("baseline")
    return side.withColumn("delta", delta).withColumn("passed", delta >= 0.0)
