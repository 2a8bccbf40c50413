"""Evaluation jobs: score, summarise, gate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.operators import comparing, scoring
from assaykit.operators import parity as par


@dataclass
class Evaluation:
    scores: DataFrame
    summary: DataFrame
    decisions: DataFrame
    problems: DataFrame


def prediction_problems(predictions: DataFrame) -> DataFrame:
    """(problem, id, and the line where it is known): rows that may not be scored, or no rows.

    An unusable line, an empty or a repeated id is a problem, and so is a set without rows.
    """
    place = [c for c in ("source_file", "line_no") if c in predictions.columns]
    bad = F.when(F.coalesce(F.length("id") == 0, F.lit(True)), F.lit("id empty"))
    if "problem" in predictions.columns:
        bad = F.when(F.col("problem").isNotNull(), F.col("problem")).otherwise(bad)
    lines = predictions.select(bad.alias("bad"), "id", *place).where("bad is not null")
    repeated = predictions.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    none = predictions.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return (
        lines.withColumnRenamed("bad", "problem")
        .unionByName(
            repeated.select(F.lit("id repeated").alias("problem"), "id"), allowMissingColumns=True
        )
        .unionByName(none.select(F.lit("no rows").alias("problem")), allowMissingColumns=True)
    )


def evaluate(predictions: DataFrame, minimums: dict[str, float] | None = None) -> Evaluation:
    """Score prediction rows (id, expected, prediction, latency_ms) against absolute gates.

    Rows with a ``problem`` (see ``read_predictions``) are not scored. While there are problems no
    gate is passed.
    """
    problems = prediction_problems(predictions)
    usable = predictions
    if "problem" in predictions.columns:
        usable = predictions.where(F.col("problem").isNull()).drop("problem")
    scores = scoring.score_predictions(usable)
    summary = scoring.summarize(scores)
    decisions = _guarded(scoring.gate_decisions(summary, minimums), problems)
    return Evaluation(scores, summary, decisions, problems)


def _guarded(decisions: DataFrame, problems: DataFrame) -> DataFrame:
    return decisions.withColumn("passed", F.col("passed") & F.lit(problems.isEmpty()))


@dataclass
class Parity:
    metrics: DataFrame
    mismatches: DataFrame
    decisions: DataFrame
    problems: DataFrame


#: Columns in which both prediction sets have to agree as soon as one of them carries them.
COHORT_IDENTITY = (
    "model_name_or_path",
    "model_revision",
    "dataset_manifest_sha256",
    "dataset_split_sha256",
    "generation_config_sha256",
)


def parity_problems(adapter: DataFrame, merged: DataFrame) -> DataFrame:
    """(problem, id): why two prediction sets may not be compared; no rows if they may.

    Of each set: unusable lines, empty and repeated ids, no rows. Of both: ids missing on a side,
    another position or expected output, and lineage that differs or that a side lacks, be it the
    column or its value.
    """
    sides = {"adapter": adapter, "merged": merged}
    lineage = [c for c in COHORT_IDENTITY if any(c in side.columns for side in sides.values())]
    found, usable = [], {}
    for name, side in sides.items():
        own = prediction_problems(side)
        found.append(own.select(F.concat(F.lit(f"{name}: "), "problem").alias("problem"), "id"))
        lacking = [c for c in lineage if c not in side.columns]
        side = side.withColumns({c: F.lit(None).cast("string") for c in lacking})
        if lineage:
            absent = side.agg(
                *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in lineage]
            ).unpivot([], lineage, "column", "absent")
            problem = F.concat(F.lit(f"{name}: "), "column", F.lit(" absent")).alias("problem")
            found.append(absent.where("absent").select(problem, F.lit(None).cast("string").alias("id")))
        if "problem" in side.columns:
            side = side.where(F.col("problem").isNull())
        usable[name] = side
    expected = [c for c in ("expected",) if all(c in side.columns for side in sides.values())]
    found.append(
        comparing.cohort_problems(usable["merged"], usable["adapter"], expected=expected, identity=lineage)
    )
    return reduce(DataFrame.unionByName, found)


def parity(adapter: DataFrame, merged: DataFrame) -> Parity:
    """Compare two prediction sets of one ordered cohort.

    ``problems`` are those of ``parity_problems``. While there are any no gate is passed. Unusable
    lines are not compared.
    """
    problems = parity_problems(adapter, merged)
    sides = [
        side.where(F.col("problem").isNull()) if "problem" in side.columns else side
        for side in (adapter, merged)
    ]
    pairs = par.pair_predictions(*sides)
    metrics = par.parity_metrics(pairs)
    decisions = _guarded(par.parity_decisions(metrics), problems)
    return Parity(metrics, par.mismatches(pairs), decisions, problems)
