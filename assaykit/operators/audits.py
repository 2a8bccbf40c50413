"""Structure, semantics and evidence audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions import text as tx
from assaykit.operators.duplicates import keys_complete

def action_allowed(category: Column, action: Column) -> Column:
    """The next action starts with a prefix allowed for its category."""
    ok = F.lit(False)
    for name, prefixes in fv.ACTION_PREFIXES.items():
        starts = F.lit(False)
        for prefix in prefixes:
            starts = starts | F.startswith(action, F.lit(prefix + "_"))
        ok = ok | ((category == name) & starts)
    return F.coalesce(ok, F.lit(False))


def semantic_checks(
    user: Column,
    expected: Column,
    provenance_ok: Column,
    consistent: Column,
    structured: Column,
    anchors: dict[str, Sequence[str]],
    priority_cues: dict[str, str],
    sentiment_cues: dict[str, str],
) -> dict[str, Column]:
    """The nine per-record checks as Boolean columns."""
    folded = F.lower(user)
    supported = F.lit(False)
    for category, words in anchors.items():
        supported = supported | ((expected["category"] == category) & tx.contains_any(folded, words))

    def cue(table: dict[str, str], label: Column) -> Column:
        wanted = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[label]
        return tx.only_cue(user, list(table.values()), wanted)

    response = expected["response"]
    return {
        "record_structure": structured,
        "category_support": supported,
        "priority_support": cue(priority_cues, expected["priority"]),
        "sentiment_support": cue(sentiment_cues, expected["sentiment"]),
        "next_action_policy": action_allowed(expected["category"], expected["next_action"]),
        "response_safe_no_completed_resolution": ~tx.unsafe_claim(response)
        & ~response.rlike(fv.PLACEHOLDER),
        "pii_absence_and_placeholder_safety": (F.size(tx.extended_pii_hits(user)) == 0)
        & (F.size(tx.extended_pii_hits(response)) == 0),
        "assistant_expected_consistency": consistent,
        "synthetic_provenance": provenance_ok,
    }


def check_counts(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, passed, failed) in one pass."""
    flags = rows.select(*[F.coalesce(ok, F.lit(False)).alias(name) for name, ok in checks.items()])
    counted = flags.agg(
        *[
            F.struct(F.count_if(name).alias("passed"), F.count_if(~F.col(name)).alias("failed")).alias(name)
            for name in checks
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.col(n)["passed"].alias("passed"),
                     F.col(n)["failed"].alias("failed"))
            for n in checks
        ]
    )
    return counted.select(F.explode(pairs).alias("x")).select("x.*")


def table_differences(
    published: DataFrame, recomputed: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """(key, field) where a published value is not the recomputed one; also one-sided and
    repeated keys. Each side is reduced to one row per key first, so repeats do not multiply.
    """
    def side(df: DataFrame, prefix: str) -> DataFrame:
        one = df.groupBy(key).agg(
            F.min(F.struct(*columns)).alias("r"), F.count(F.lit(1)).alias(f"{prefix}copies")
        )
        return one.select(
            key, *[F.col("r")[c].alias(f"{prefix}{c}") for c in columns], f"{prefix}copies",
            F.lit(True).alias(f"{prefix}here"),
        )

    both = side(published, "p_").join(side(recomputed, "r_"), key, "full_outer")
    missing = F.when(F.col("r_here").isNull(), "not recomputed").when(
        F.col("p_here").isNull(), "not published"
    )
    differs = [
        F.when(
            F.col("p_here").isNotNull() & F.col("r_here").isNotNull()
            & ~F.col(f"p_{c}").eqNullSafe(F.col(f"r_{c}")),
            F.lit(c),
        )
        for c in columns
    ]
    repeated = F.when((F.col("p_copies") > 1) | (F.col("r_copies") > 1), "repeated")
    return both.select(
        key, F.explode(F.array_compact(F.array(missing, repeated, *differs))).alias("field")
    )


def summary_differences(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Metrics whose published value is not the recomputed one within the number tolerance.

    Inputs are (metric, value) rows.
    """
    both = published.select("metric", F.col("value").alias("p")).join(
        recomputed.select("metric", F.col("value").alias("r")), "metric", "full_outer"
    )
    same = tx.same_number(F.col("p"), F.col("r")) | (F.col("p").isNull() & F.col("r").isNull())
    return both.where(~F.coalesce(same, F.lit(False))).select(
        "metric", F.col("p").alias("published"), F.col("r").alias("recomputed")
    )


def threshold_problems(
    thresholds: DataFrame, summary: DataFrame, minimums: dict[str, float]
) -> DataFrame:
    """(metric, problem): incomplete names, values that differ from the summary, other minimums,
    and pass flags that do not follow from value and minimum.
    """
    spark = thresholds.sparkSession
    wanted = spark.createDataFrame(list(minimums.items()), "metric string, want double")
    joined = thresholds.join(F.broadcast(wanted), "metric").join(
        summary.select("metric", F.col("value").alias("summary_value")), "metric", "left"
    )
    found = joined.select(
        "metric",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.coalesce(tx.same_number(F.col("value"), F.col("summary_value")), F.lit(False)),
                           F.lit("value differs from summary")),
                    F.when(~tx.same_number(F.col("minimum"), F.col("want")),
                           F.lit("minimum differs from configuration")),
                    F.when(F.col("passed") != (F.col("value") >= F.col("minimum")),
                           F.lit("pass flag inconsistent")),
                )
            )
        ).alias("problem"),
    )
    return keys_complete(thresholds, list(minimums), "metric").unionByName(found)


def header_mismatches(rows: DataFrame, header: DataFrame, fields: Sequence[str], key: str) -> DataFrame:
    """(field, rows) where row values differ from the artifact header they belong to."""
    wanted = header.select(key, *[F.col(f).alias(f"h_{f}") for f in fields])
    # Equal rows are counted first: a header with most of the rows sends few records to the join.
    combined = rows.groupBy(key, *fields).agg(F.count(F.lit(1)).alias("__n"))
    joined = combined.join(wanted, key, "left")
    counted = joined.agg(
        *[
            F.coalesce(
                F.sum(F.when(~F.col(f).eqNullSafe(F.col(f"h_{f}")), F.col("__n"))), F.lit(0)
            ).alias(f)
            for f in fields
        ]
    )
    return counted.unpivot([], list(fields), "field", "rows")


def digest_map_problems(rows: DataFrame, row_id: str, digests: str) -> DataFrame:
    """(row, problem) for digest maps that are empty, malformed or hold a filler digest."""
    values = F.map_values(digests)
    problem = (
        F.when(F.size(values) == 0, "empty")
        .when(F.exists(values, lambda v: ~F.coalesce(v.rlike(fv.SHA256_HEX), F.lit(False))), "malformed")
        .when(F.exists(values, lambda v: v.rlike(fv.REPEATED_CHARACTER)), "repeated character")
        .when(F.exists(F.map_keys(digests), lambda k: k == ""), "unnamed")
    )
    return rows.select(row_id, problem.alias("problem")).where(F.col("problem").isNotNull())


def lineage_checks(edges: DataFrame) -> DataFrame:
    """(check, declared, observed, passed) from a table of named digest pairs."""
    return edges.withColumn(
        "passed", F.coalesce(F.col("declared") == F.col("observed"), F.lit(False))
    )


def prompt_shape(prompts: DataFrame, prompt_id: str, text: Column) -> DataFrame:
    """Per prompt text: mentions of every label and every output field."""
    labels = [*fv.CATEGORIES, *fv.PRIORITIES, *fv.SENTIMENTS]
    return prompts.select(
        prompt_id,
        tx.contains_all(text, labels).alias("has_labels"),
        tx.contains_all(text, fv.OUTPUT_FIELDS).alias("has_fields"),
    )
