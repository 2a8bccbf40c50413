"""Load-test outcomes and sustained alert conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.operators.percentiles import exact_percentiles
from assaykit.session import durable


def load_counts(outcomes: DataFrame, group: Sequence[str | Column] = ()) -> DataFrame:
    n = F.count(F.lit(1))
    return outcomes.groupBy(*group).agg(
        n.alias("requests"),
        F.count_if(F.col("status") == 200).alias("successes"),
        F.count_if("schema_valid").alias("schema_valid_responses"),
        F.count_if("request_id").alias("request_ids_received"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    n = F.col("requests")
    return counts.withColumns(
        {
            "success_rate": F.col("successes") / n,
            "schema_valid_rate": F.col("schema_valid_responses") / n,
            "request_id_rate": F.col("request_ids_received") / n,
        }
    )


def load_summary(
    outcomes: DataFrame,
    group: Sequence[str] = (),
    min_success_rate: float = 1.0,
    min_schema_valid_rate: float = 1.0,
    min_request_id_rate: float = 1.0,
    max_p95_ms: float = 5000.0,
) -> DataFrame:
    """Counts, rates, nearest-rank percentiles and the gate, per group."""
    for name, rate in (
        ("min_success_rate", min_success_rate),
        ("min_schema_valid_rate", min_schema_valid_rate),
        ("min_request_id_rate", min_request_id_rate),
    ):
        if not 0.0 <= rate <= 1.0:
            raise ValueError(f"{name}={rate}: a rate lies in [0, 1]")
    if not 0.0 < max_p95_ms < float("inf"):
        raise ValueError(f"max_p95_ms={max_p95_ms}: expected more than 0 and less than infinity")
    if not group:
        one = load_summary(
            outcomes.withColumn("__one", F.lit(1)), ["__one"], min_success_rate,
            min_schema_valid_rate, min_request_id_rate, max_p95_ms,
        )
        return one.drop("__one")
    rates = with_rates(load_counts(outcomes, group))
    ranked = exact_percentiles(
        outcomes, group, "latency_ms", {"latency_p50_ms": 0.50, "latency_p95_ms": 0.95}, "nearest"
    ).drop("count", "mean")
    passed = (
        (F.col("success_rate") >= min_success_rate)
        & (F.col("schema_valid_rate") >= min_schema_valid_rate)
        & (F.col("request_id_rate") >= min_request_id_rate)
        & F.coalesce(F.col("latency_p95_ms") <= max_p95_ms, F.lit(False))
    )
    return rates.join(ranked, list(group), "left").withColumn("passed", passed)


def outcome_histograms(outcomes: DataFrame) -> DataFrame:
    """(kind, value, responses): status codes other than 0 and error codes other than null or ''."""
    kinds = F.array_compact(
        F.array(
            F.when(F.col("status") != 0, F.struct(
                F.lit("status").alias("kind"), F.col("status").cast("string").alias("value"))),
            F.when(F.col("error_code") != "", F.struct(
                F.lit("error").alias("kind"), F.col("error_code").alias("value"))),
        )
    )
    return (
        outcomes.select(F.explode(kinds).alias("x"))
        .groupBy("x.kind", "x.value")
        .agg(F.count(F.lit(1)).alias("responses"))
    )


def breaches(value: Column, operator: str, limit: float) -> Column:
    return {
        "==": value == limit,
        "!=": value != limit,
        ">": value > limit,
        ">=": value >= limit,
        "<": value < limit,
        "<=": value <= limit,
    }[operator]


#: Distinct (series, time, condition) records of one piece, and pieces joined up in one step.
PIECE_ROWS = 1_000_000
FAN_IN = 1_000


def sustained_alerts(
    samples: DataFrame,
    operator: str,
    limit: float,
    hold_seconds: float,
    series: str = "series",
    max_gap_seconds: float | None = None,
    piece_rows: int = PIECE_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Episodes in which a condition held at every sample for at least ``hold_seconds``.

    A sample whose value is null does not breach. Of samples of one series and time those that do
    not breach come first. With ``max_gap_seconds`` a longer pause ends an episode.

    Samples are laid out in the order of series and time and cut into even pieces, so one series
    may hold all of them. Runs inside a piece are complete. The first and last run of a piece can
    go on in its neighbours: they are joined up ``fan_in`` pieces at a time, then as many of those,
    until one step covers all. Each step keeps at most two open runs per series and part, so no
    window holds more than a piece, or two records for each of ``fan_in`` parts.
    """
    bad = F.coalesce(breaches(F.col("value"), operator, limit), F.lit(False))
    marked = samples.select(
        F.col(series).alias("series"), F.col("ts").cast("timestamp").alias("ts"), bad.alias("bad")
    )
    points = durable(marked.groupBy("series", "ts", "bad").agg(F.count(F.lit(1)).alias("samples")))
    pieces = -(-points.count() // piece_rows)
    order = ["series", "ts", "bad"]
    if pieces > 1:
        cut = points.repartitionByRange(pieces, *order).withColumn("piece", F.spark_partition_id())
        points = durable(cut)
    else:
        points = points.withColumn("piece", F.lit(0))
    runs = _chained(
        points.select(
            "series", "piece", "bad", "samples", F.col("ts").alias("start"), F.col("ts").alias("end"),
            F.lit(True).alias("opens"), F.lit(True).alias("closes"),
        ),
        max_gap_seconds,
    )
    complete = []
    while pieces > 1:
        runs = durable(runs)
        complete.append(runs.where("NOT opens AND NOT closes"))
        pieces = -(-pieces // fan_in)
        whole = F.floor(F.col("piece") / fan_in).cast("int") if pieces > 1 else F.lit(0)
        runs = _chained(runs.where("opens OR closes").withColumn("piece", whole), max_gap_seconds)
    for part in complete:
        runs = runs.unionByName(part)
    held = F.unix_micros("end") - F.unix_micros("start")
    found = runs.where("bad").where(held >= int(hold_seconds * 1_000_000))
    return found.select(F.col("series").alias(series), "start", "end", "samples")


def _chained(runs: DataFrame, max_gap_seconds: float | None) -> DataFrame:
    """Join neighbouring runs of the same condition within (series, piece).

    ``opens`` and ``closes`` say whether a run is the first and the last of its part; only runs
    that face each other there are joined. Afterwards they speak of the larger part.
    """
    along = Window.partitionBy("series", "piece").orderBy("start", "bad")
    joined = F.col("opens") & F.lag("closes").over(along) & (F.lag("bad").over(along) == F.col("bad"))
    if max_gap_seconds is not None:
        gap = F.unix_micros("start") - F.unix_micros(F.lag("end").over(along))
        joined = joined & (gap <= int(max_gap_seconds * 1_000_000))
    fresh = (~F.coalesce(joined, F.lit(False))).cast("int")
    numbered = runs.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(along))
    merged = numbered.groupBy("series", "piece", "run").agg(
        F.first("bad").alias("bad"), F.sum("samples").alias("samples"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    )
    last = F.max("run").over(Window.partitionBy("series", "piece"))
    return merged.select(
        "series", "piece", "bad", "samples", "start", "end",
        (F.col("run") == 1).alias("opens"), (F.col("run") == last).alias("closes"),
    )


def alert_rules(samples: DataFrame, rules=fv.ALERT_RULES) -> DataFrame:
    """Apply a rule table; summed rules add all series of a metric per sample time first."""
    found = None
    for name, series, operator, limit, seconds, summed in rules:
        chosen = samples.where(
            (F.col("series") == series) | F.startswith("series", F.lit(series + "{"))
        )
        if summed:
            chosen = chosen.groupBy("ts").agg(F.sum("value").alias("value")).withColumn(
                "series", F.lit(series)
            )
        rows = sustained_alerts(chosen, operator, limit, seconds).withColumn("rule", F.lit(name))
        found = rows if found is None else found.unionByName(rows)
    return found
