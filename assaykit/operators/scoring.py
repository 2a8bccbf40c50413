"""Scoring of structured predictions: rows, summary, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions import strict_json as sj
from assaykit.functions.stages import with_computed
from assaykit.functions.text import safe_response
from assaykit.operators.percentiles import exact_percentiles

SCORE_COLUMNS = (
    "id",
    "expected",
    "prediction",
    "parsed",
    "parse_error",
    "strict_json_only",
    "schema_valid",
    "field_completeness",
    "category_correct",
    "priority_correct",
    "sentiment_correct",
    "response_policy_compliant",
    "exact_match",
    "predicted_category",
    "predicted_priority",
    "predicted_sentiment",
    "latency_ms",
)
RATES = {
    "strict_json_rate": "strict_json_only",
    "schema_valid_rate": "schema_valid",
    "field_completeness_rate": "field_completeness",
    "category_accuracy": "category_correct",
    "priority_accuracy": "priority_correct",
    "sentiment_accuracy": "sentiment_correct",
    "response_policy_rate": "response_policy_compliant",
    "exact_match_rate": "exact_match",
}


def default_id(record_id: Column, position: Column) -> Column:
    """Id of a row without one, from its 1-based position."""
    return F.coalesce(record_id, F.format_string("example-%05d", position))


def score_predictions(predictions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Score rows of (id, expected struct, prediction text, latency_ms).

    Labels and completeness count for recovered objects too; schema validity and exact match
    need the prediction to be one bare JSON object. ``keep`` names further columns to carry.
    """
    members = F.col("__members")
    flat = predictions.select(
        "id", "prediction", "latency_ms", *keep,
        *[F.col("expected")[name].alias(f"__want_{name}") for name in fv.OUTPUT_FIELDS],
    )
    parsed = with_computed(
        sj.with_object(flat, "prediction", "json"),
        {"__members": sj.members_of(F.col("json_object"))},
    )
    parsed = with_computed(parsed, {"__out": sj.output_members(members)})
    errors = F.when(members.isNotNull(), sj.field_errors(F.col("__out"), members))
    parsed = with_computed(parsed, {"__errors": errors})
    out = F.col("__out")
    expected = F.struct(*[F.col(f"__want_{name}").alias(name) for name in fv.OUTPUT_FIELDS])
    strict = F.col("json_strict")
    valid = strict & F.coalesce(F.col("__errors") == 0, F.lit(False))
    error = (
        F.when(F.col("json_error").isNotNull(), F.col("json_error"))
        .when(F.col("json_object").isNull(), "no JSON object found")
        .when(~strict, "output is not one bare JSON object")
        .when(
            F.col("__errors") > 0,
            F.format_string("schema validation failed: %d error(s)", F.col("__errors")),
        )
    )
    exact = F.lit(True)
    trimmed, wanted = sj.trimmed_output(out), sj.trimmed_output(expected)
    for name in fv.OUTPUT_FIELDS:
        exact = exact & trimmed[name].eqNullSafe(wanted[name])
    correct = [
        F.coalesce(out[name] == expected[name], F.lit(False)).alias(f"{name}_correct")
        for name in fv.LABEL_DIMENSIONS
    ]
    guessed = [out[name].alias(f"predicted_{name}") for name in fv.LABEL_DIMENSIONS]
    scored = parsed.select(
        "id",
        expected.alias("expected"),
        "prediction",
        F.to_json("json_object").alias("parsed"),
        error.alias("parse_error"),
        strict.alias("strict_json_only"),
        valid.alias("schema_valid"),
        (sj.filled_fields(members) / F.lit(float(len(fv.OUTPUT_FIELDS)))).alias(
            "field_completeness"
        ),
        *correct,
        safe_response(out["response"]).alias("response_policy_compliant"),
        (valid & exact).alias("exact_match"),
        *guessed,
        "latency_ms",
        *keep,
    )
    return scored


def mean_of(value: Column) -> Column:
    """Mean of a Boolean or number; 0.0 over no rows."""
    return F.coalesce(F.avg(value.cast("double")), F.lit(0.0))


def macro_f1(expected: Column, predicted: Column, labels: Sequence[str]) -> Column:
    """Unweighted F1 over a given label set as one aggregate expression, without a shuffle of its own.

    A label without any hit or miss scores 0; predictions outside the set are misses only.
    """
    total = F.lit(0.0)
    for label in labels:
        actual = F.coalesce(expected == label, F.lit(False))
        guess = F.coalesce(predicted == label, F.lit(False))
        hits = F.count_if(actual & guess)
        cells = F.count_if(actual) + F.count_if(guess)  # = 2 hits + false alarms + misses
        total = total + F.when(cells > 0, 2.0 * hits / cells).otherwise(0.0)
    return total / F.lit(float(len(labels)))


def macro_f1_open(
    rows: DataFrame, expected: str, predicted: str, group: Sequence[str] = ()
) -> DataFrame:
    """Macro-F1 over every label that occurs, a missing prediction counting as its own label."""
    guess = F.coalesce(F.col(predicted), F.lit(fv.INVALID_LABEL))
    pairs = rows.groupBy(*group, F.col(expected).alias("__e"), guess.alias("__g")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    sides = pairs.select(
        *group,
        F.explode(
            F.array(
                F.struct(F.col("__e").alias("label"), F.col("__n").alias("cells"),
                         F.when(F.col("__e") == F.col("__g"), F.col("__n")).otherwise(0).alias("hits")),
                F.struct(F.col("__g").alias("label"), F.col("__n").alias("cells"),
                         F.lit(0).cast("long").alias("hits")),
            )
        ).alias("x"),
    ).select(*group, "x.*")
    per_label = sides.groupBy(*group, "label").agg(
        F.sum("hits").alias("hits"), F.sum("cells").alias("cells")
    )
    return per_label.groupBy(*group).agg(
        F.avg(2.0 * F.col("hits") / F.col("cells")).alias("macro_f1"),
        F.count(F.lit(1)).alias("labels"),
    )


def label_confusion(rows: DataFrame, expected: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """True positives, false positives and false negatives per label of a given set."""
    known = F.array(*[F.lit(label) for label in labels])
    actual, guess = F.col(expected), F.coalesce(F.col(predicted), F.lit(fv.INVALID_LABEL))
    counted = rows.groupBy(actual.alias("__e"), guess.alias("__g")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    return (
        counted.select(F.explode(known).alias("label"), "__e", "__g", "__n")
        .groupBy("label")
        .agg(
            F.sum(F.when((F.col("__e") == F.col("label")) & (F.col("__g") == F.col("label")),
                         F.col("__n")).otherwise(0)).alias("true_positive"),
            F.sum(F.when((F.col("__e") != F.col("label")) & (F.col("__g") == F.col("label")),
                         F.col("__n")).otherwise(0)).alias("false_positive"),
            F.sum(F.when((F.col("__e") == F.col("label")) & (F.col("__g") != F.col("label")),
                         F.col("__n")).otherwise(0)).alias("false_negative"),
        )
    )


def summarize(scores: DataFrame, group: Sequence[str] = (), latency: bool = True) -> DataFrame:
    """The evaluation metrics, one row per group; one aggregation pass plus the exact percentiles."""
    metrics = [F.count(F.lit(1)).alias("examples")]
    metrics += [mean_of(F.col(flag)).alias(rate) for rate, flag in RATES.items()]
    metrics += [
        macro_f1(F.col(f"expected.{name}"), F.col(f"predicted_{name}"), labels).alias(
            f"{name}_macro_f1"
        )
        for name, labels in fv.LABEL_DIMENSIONS.items()
    ]
    summary = scores.groupBy(*group).agg(*metrics)
    if not latency:
        return summary
    keys = list(group) or ["__one"]
    timed = exact_percentiles(
        scores, group, "latency_ms", {"latency_p50_ms": 0.50, "latency_p95_ms": 0.95}, "linear"
    ).select(
        *group, F.col("mean").alias("latency_mean_ms"), "latency_p50_ms", "latency_p95_ms"
    )
    if not group:
        summary = summary.withColumn("__one", F.lit(1))
        timed = timed.withColumn("__one", F.lit(1))
    return summary.join(timed, keys, "left").drop("__one")


def metric_rows(summary: DataFrame, metrics: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Summary columns as (metric, value) rows."""
    return summary.unpivot(
        list(group), [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value"
    )


def gate_decisions(
    summary: DataFrame, minimums: dict[str, float] | None = None, group: Sequence[str] = ()
) -> DataFrame:
    """(metric, value, minimum, passed) per absolute gate; a gate passes at its minimum."""
    minimums = minimums or fv.ABSOLUTE_MINIMUMS
    rows = metric_rows(summary, list(minimums), group)
    minimum = F.lit(None).cast("double")
    for metric, value in minimums.items():
        minimum = F.when(F.col("metric") == metric, F.lit(float(value))).otherwise(minimum)
    return rows.withColumn("minimum", minimum).withColumn(
        "passed", F.col("value") >= F.col("minimum")
    )


def all_passed(decisions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return decisions.groupBy(*group).agg(F.bool_and("passed").alias("passed"))
