"""Streaming load summaries and sustained alerts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from assaykit.operators.serving import breaches, load_counts, with_rates
from assaykit.streaming.closing import END_OF_TIME

#: Samples of a series in one record of the state.
PACKED = 10_000


def windowed_load(outcomes: DataFrame, width: str = "1 minute", delay: str = "2 minutes") -> DataFrame:
    """Load counts, rates and approximate percentiles per tumbling window of ``ts``.

    A running window cannot be read twice, so its percentiles come from a mergeable sketch;
    exact ones are the batch summary's.
    """
    windowed = outcomes.withWatermark("ts", delay).withColumn("window", F.window("ts", width))
    n = F.count(F.lit(1))
    counts = windowed.groupBy("window").agg(
        n.alias("requests"),
        F.count_if(F.col("status") == 200).alias("successes"),
        F.count_if("schema_valid").alias("schema_valid_responses"),
        F.count_if("request_id").alias("request_ids_received"),
        F.percentile_approx("latency_ms", [0.5, 0.95], 10_000).alias("latency_p50_p95_ms"),
    )
    return with_rates(counts).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "*"
    ).drop("window")


def windowed_load_batch(outcomes: DataFrame, width: str = "1 minute") -> DataFrame:
    """The same windows over a finished table."""
    keyed = outcomes.withColumn("start", F.window("ts", width)["start"])
    return with_rates(load_counts(keyed, ["start"]))


class SustainedAlerts(StatefulProcessor):
    """Follows one series in event-time order.

    Samples wait in a buffer until the watermark has passed them, so a sample that is late by less
    than the delay takes its place among the others. What is kept beyond the buffer is one record:
    the start of the running breach, its last sample, and whether it has fired. A series without a
    breach and without waiting samples keeps nothing; nor does a breach that has paused for longer
    than ``max_gap``.
    """

    def __init__(self, hold_us: int, max_gap_us: int | None):
        self.hold, self.max_gap = hold_us, max_gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # samples packed by batch: one call to the state store for many, which a call for each is not
        self.waiting = handle.getListState("waiting", "ts binary, bad binary")
        self.run = handle.getValueState("run", "since long, last long, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            return
        first = None
        for frame in rows:
            ts = _micros(frame["ts"])
            if len(ts):
                self._wait(ts, frame["bad"].to_numpy(dtype=bool))
                first = ts.min() if first is None else min(first, ts.min())
        if first is not None:
            self.handle.registerTimer(_due(int(first)))
        yield from ()

    def _wait(self, ts: np.ndarray, bad: np.ndarray) -> None:
        for at in range(0, len(ts), PACKED):
            part = slice(at, at + PACKED)
            self.waiting.appendValue((ts[part].astype("<i8").tobytes(), bad[part].tobytes()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        parts = list(self.waiting.get())
        ts = np.frombuffer(b"".join(part[0] for part in parts), dtype="<i8")
        breach = np.frombuffer(b"".join(part[1] for part in parts), dtype=bool)
        later = ts > passed
        left = ts[later]
        if len(left) < len(ts):
            self.waiting.clear()
            self._wait(left, breach[later])
        ts, breach = ts[~later], breach[~later]
        order = np.lexsort((breach, ts))  # at equal times those that do not breach first
        known = self.run.get()
        since, last, fired = known or (None, None, False)
        found = []
        for at, bad in zip(ts[order].tolist(), breach[order].tolist(), strict=True):
            if since is not None and (not bad or self.max_gap is not None and at - last > self.max_gap):
                since, fired = None, False
            if bad:
                since, last = at if since is None else since, at
                if not fired and at - since >= self.hold:
                    fired = True
                    found.append((key[0], since, at))
        if len(left):
            self.handle.registerTimer(_due(int(left.min())))
        if since is not None and self.max_gap is not None:
            if last + self.max_gap < passed:  # whatever comes is later than the longest pause
                since = None
            elif not len(left):
                self.handle.registerTimer(_due(last + self.max_gap + 1))
        if since is not None:
            self.run.update((since, last, fired))
        elif known is not None:
            self.run.clear()
        if found:
            frame = pd.DataFrame(found, columns=["series", "start", "fired"])
            for name in ("start", "fired"):
                frame[name] = pd.to_datetime(frame[name], unit="us").astype("datetime64[us]")
            yield frame

    def close(self) -> None:
        pass


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype("int64")


def _due(ts_us: int) -> int:
    """The watermark, in milliseconds, that has passed a time."""
    return -(-ts_us // 1000)


def sustained_stream(
    samples: DataFrame, operator: str, limit: float, hold_seconds: float, delay: str | None = "1 minute",
    max_gap_seconds: float | None = None,
) -> DataFrame:
    """(series, start, fired) the first time a condition has held for ``hold_seconds``.

    Gives what ``sustained_alerts`` gives on the finished table: samples count in the order of
    their event times (at equal times those that do not breach first), in whatever order they come
    within ``delay``. ``delay`` None is for samples that have a watermark. An alert comes out when
    the watermark has passed the sample that fires it. Samples later than the delay, and samples
    without a series, are left out. Without ``max_gap_seconds`` a series that ends in a breach keeps
    one record.
    """
    if delay is not None:
        samples = samples.withWatermark("ts", delay)
    bad = F.coalesce(breaches(F.col("value"), operator, limit), F.lit(False))
    gap = None if max_gap_seconds is None else int(max_gap_seconds * 1_000_000)
    return (
        samples.select("series", "ts", bad.alias("bad"))
        .groupBy("series")
        .transformWithStateInPandas(
            SustainedAlerts(int(hold_seconds * 1_000_000), gap),
            "series string, start timestamp, fired timestamp",
            "append",
            "eventTime",
        )
    )


def summed_stream(samples: DataFrame, metric: str, delay: str = "1 minute") -> DataFrame:
    """The sum over all series of a metric per sample time, as one series; has a watermark.

    A sum comes out when the watermark has passed its time, so it holds every sample in time.
    """
    chosen = samples.withWatermark("ts", delay).where(_of_metric(metric))
    sums = chosen.groupBy("ts").agg(F.sum("value").alias("value"))
    return sums.select(F.lit(metric).alias("series"), "ts", "value")


def _of_metric(metric: str):
    """Rows of a metric; the end of a closed stream passes too, to move the watermark."""
    ends = F.col("ts") >= F.lit(END_OF_TIME).cast("timestamp")
    return ends | (F.col("series") == metric) | F.startswith("series", F.lit(metric + "{"))


def rule_stream(samples: DataFrame, rule, delay: str = "1 minute", max_gap_seconds: float | None = None) -> DataFrame:
    """Alerts of one rule of the rule table, with its name."""
    name, metric, operator, limit, seconds, summed = rule
    if summed:
        chosen = summed_stream(samples, metric, delay)
    else:
        chosen = samples.withWatermark("ts", delay).where(_of_metric(metric))
    fired = sustained_stream(chosen, operator, limit, seconds, None, max_gap_seconds)
    return fired.withColumn("rule", F.lit(name))
