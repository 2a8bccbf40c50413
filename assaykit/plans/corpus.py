"""Corpus jobs: validate, prepare, verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions import digests
from assaykit.functions.text import with_fingerprint
from assaykit.operators import distributions as dist
from assaykit.operators import rules
from assaykit.operators.conversations import prepared_json, prompt_completion
from assaykit.operators.duplicates import shared_across
from assaykit.operators.splitting import Balance, stratified_split
from assaykit.session import durable, small_side


@dataclass
class Validation:
    clean: DataFrame
    violations: DataFrame
    first_error: DataFrame


def validate(lines: DataFrame, system_text: str, line: str = "line") -> Validation:
    """Check (line_no, line) rows, with ``source_file`` when they come from several files.

    Lines are parsed and checked once. ``clean`` holds the records without any violation.
    """
    checked = durable(rules.checked_records(lines, system_text, line).drop(line))
    found = durable(rules.violations_of(checked))
    place = rules.place_of(lines)
    bad = small_side(durable(found.select(*place).distinct()))
    clean = checked.where(F.size("broken") == 0).join(bad, place, "left_anti")
    return Validation(clean.select(*place, "record.*"), found, rules.first_error(found))


@dataclass
class Prepared:
    records: DataFrame
    manifest_splits: DataFrame
    manifest_labels: DataFrame
    coverage: DataFrame
    leakage: DataFrame


def prepare(
    clean: DataFrame,
    seed: int = 42,
    fractions: dict[str, float] | None = None,
    balance: Balance | None = None,
    prefix_hex: int = 3,
) -> Prepared:
    """Split validated records and describe the result."""
    placed = stratified_split(
        clean.select("id", "expected.category", "expected.priority", "expected.sentiment"),
        "id", "category", balance, seed, fractions, prefix_hex=prefix_hex,
    )
    record = F.struct(*[F.col(c) for c in
                        ("id", "messages", "expected", "provenance", "pii_placeholders")])
    projected = clean.select(record.alias("record")).select(*prompt_completion(F.col("record")))
    records = projected.join(placed, "id").withColumn("line", prepared_json())
    labels = {name: F.col(f"expected.{name}") for name in fv.LABEL_DIMENSIONS}
    flat = records.select("split", *[label.alias(name) for name, label in labels.items()])
    user = with_fingerprint(records, F.get("prompt", F.lit(1))["content"])
    return Prepared(
        records=records,
        manifest_splits=digests.tree_digest(records, ["split"], "position", F.col("line")),
        manifest_labels=dist.label_distribution(records, labels, ["split"]),
        coverage=dist.holdout_coverage(flat, "split", fv.LABEL_DIMENSIONS),
        leakage=shared_across(user, "fingerprint", "split"),
    )


def verify(
    expected: DataFrame,
    published: DataFrame,
    declared_splits: DataFrame,
    declared_labels: DataFrame,
) -> DataFrame:
    """(check, split, cases) problems of a published split set against its regeneration.

    ``expected`` and ``published``: split, position, id, line. ``declared_splits``: split,
    lines, digest. ``declared_labels``: split, dimension, label, rows; ``expected`` carries
    category, priority and sentiment for it. No rows means verified.
    """
    key = ["split", "position"]
    pairs = (
        expected.select(*key, F.col("id").alias("e_id"), F.sha2("line", 256).alias("e_line"))
        .join(
            published.select(*key, F.col("id").alias("p_id"), F.sha2("line", 256).alias("p_line")),
            key,
            "full_outer",
        )
    )
    row_problem = (
        F.when(F.col("p_id").isNull(), "row missing")
        .when(F.col("e_id").isNull(), "row unexpected")
        .when(F.col("e_id") != F.col("p_id"), "ordered ids differ")
        .when(F.col("e_line") != F.col("p_line"), "bytes differ")
    )
    rows = pairs.select(row_problem.alias("check"), "split").where(F.col("check").isNotNull())

    digest = digests.tree_digest(expected, ["split"], "position", F.col("line"))
    manifest = digest.select("split", F.col("lines").alias("n"), F.col("digest").alias("d")).join(
        declared_splits, "split", "full_outer"
    )
    heads = manifest.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.col("n").eqNullSafe(F.col("lines")), F.lit("declared count differs")),
                    F.when(~F.col("d").eqNullSafe(F.col("digest")), F.lit("declared digest differs")),
                )
            )
        ).alias("check"),
        "split",
    )
    labels = dist.label_distribution(
        expected, {name: F.col(name) for name in fv.LABEL_DIMENSIONS}, ["split"]
    )
    label_key = ["split", "dimension", "label"]
    counted = (
        labels.withColumnRenamed("rows", "n")
        .join(declared_labels, label_key, "full_outer")
        .where(~F.col("n").eqNullSafe(F.col("rows")))
        .select(F.lit("label distribution differs").alias("check"), "split")
    )
    return (
        rows.unionByName(heads).unionByName(counted)
        .groupBy("check", "split").agg(F.count(F.lit(1)).alias("cases"))
    )


def manifest_settings_match(
    seed: int, fractions: dict[str, float], declared_seed: int, declared: dict[str, float]
) -> bool:
    """Seed and fractions of a manifest equal the configured ones."""
    return (
        seed == declared_seed
        and set(declared) == set(fv.SPLITS)
        and all(abs(declared[s] - fractions[s]) <= fv.NUMBER_TOLERANCE for s in fv.SPLITS)
    )
