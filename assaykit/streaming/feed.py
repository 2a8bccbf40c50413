"""Incremental corpus intake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from assaykit.functions.text import with_fingerprint


def first_in_feed(records: DataFrame, text: Column, ts: str, delay: str) -> DataFrame:
    """Records whose fingerprint has not been seen within ``delay`` of event time.

    State is bounded by the delay. Event times must lie after 1970-01-01, where every watermark
    starts. The batch job over the whole corpus stays authoritative.
    """
    keyed = with_fingerprint(records, text).withWatermark(ts, delay)
    return keyed.dropDuplicatesWithinWatermark(["fingerprint"])
