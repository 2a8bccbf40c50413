"""Sustained alerts in batch and as a stream against a plain walk over the samples."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.operators import serving
from assaykit.streaming import closing
from assaykit.streaming import serving as stream

START = 1_700_000_000


def episodes(rows, hold, gap=None):
    """(series, start, end, samples, first time at which the hold was reached), bad value 1."""
    found = []
    for name in {r[0] for r in rows}:
        run = None
        for t, bad in sorted((t, v == 1.0) for s, t, v in rows if s == name):
            if run and (not bad or gap is not None and t - run[1] > gap):
                found.append((name, *run))
                run = None
            if bad:
                run = [t, t, 0, None] if run is None else run
                run[1], run[2] = t, run[2] + 1
                if run[3] is None and t - run[0] >= hold:
                    run[3] = t
        if run:
            found.append((name, *run))
    return sorted(e for e in found if e[2] - e[1] >= hold)


def some_samples(seed, n, names, pause=0.0):
    rng = random.Random(seed)
    rows, clock = [], dict.fromkeys(names, START)
    for _ in range(n):
        name = rng.choice(names)
        clock[name] += rng.choice([0, 15, 15, 15, 30]) + (3600 if rng.random() < pause else 0)
        value = rng.choice([1.0] * 9 + [0.0, None])
        rows.append((name, clock[name], value))
    return rows


def frame(spark, rows):
    made = spark.createDataFrame(rows, "series string, t long, value double")
    return made.select("series", F.timestamp_seconds("t").alias("ts"), "value", F.lit(1).alias("piece"))


@pytest.mark.parametrize("piece_rows, fan_in", [(10**6, 1000), (50, 1000), (50, 3)])
@pytest.mark.parametrize("gap", [None, 600])
def test_runs_join_up_over_pieces(spark, piece_rows, fan_in, gap):
    names = ["hot"] * 20 + ["a", "b", "c"]
    rows = some_samples(3, 1500, names, 0.02)
    got = serving.sustained_alerts(
        frame(spark, rows).repartition(5), "==", 1.0, 120, max_gap_seconds=gap, piece_rows=piece_rows, fan_in=fan_in
    )
    assert got.columns == ["series", "start", "end", "samples"]
    got = got.select("series", F.unix_seconds("start"), F.unix_seconds("end"), "samples").collect()
    assert sorted(map(tuple, got)) == [e[:4] for e in episodes(rows, 120, gap)]


def test_one_series_holds_all_rows(spark):
    rows = [("s", START + 15 * i, 0.0 if i in (700, 701, 1500) else 1.0) for i in range(2000)]
    rows += [("s", START + 15 * 400, 1.0)] * 300  # many samples at one time
    got = serving.sustained_alerts(frame(spark, rows), "==", 1.0, 120, piece_rows=20, fan_in=4)
    got = got.select("series", F.unix_seconds("start"), F.unix_seconds("end"), "samples").collect()
    assert sorted(map(tuple, got)) == [e[:4] for e in episodes(rows, 120)]
    assert [e[3] for e in episodes(rows, 120)] == [1000, 798, 499]


def test_equal_times_put_good_samples_first(spark):
    rows = [("s", START + 15 * i, 1.0) for i in range(20)] + [("s", START + 150, 0.0)]
    want = [("s", START + 150, START + 285, 10)]
    for order in (rows, rows[::-1]):
        got = serving.sustained_alerts(frame(spark, order), "==", 1.0, 120)
        got = got.select("series", F.unix_seconds("start"), F.unix_seconds("end"), "samples").collect()
        assert sorted(map(tuple, got))[-1:] == want


def test_no_samples(spark):
    assert serving.sustained_alerts(frame(spark, []), "==", 1.0, 120).collect() == []


def files(spark, folder, parts):
    for n, rows in enumerate(parts):
        target = f"{folder}/f{n}"
        frame(spark, rows).drop("piece").coalesce(1).write.parquet(target)
        for name in os.listdir(target):  # files are read in the order of their times
            os.utime(f"{target}/{name}", (START + n, START + n))
    return (
        spark.readStream.schema("series string, ts timestamp, value double")
        .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    )


def shuffled_within(rows, seconds, seed):
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: r[1] + rng.uniform(0, seconds))


@pytest.mark.parametrize("gap", [None, 600])
def test_late_samples_give_the_batch_result(spark, tmp_path, gap):
    rows = some_samples(5, 400, ["a", "a", "b", "c"], 0.01)
    rows = shuffled_within(rows, 200, 6)
    assert any(x[1] > y[1] for x, y in zip(rows, rows[1:], strict=False))
    parts = [rows[i : i + 80] for i in range(0, len(rows), 80)]
    feed = closing.Closable(spark, files(spark, str(tmp_path / "in"), parts), "ts")
    fired = stream.sustained_stream(feed.rows, "==", 1.0, 120, "5 minutes", gap)
    got = closing.run_to_table(fired, spark, close=feed.close)
    got = got.select("series", F.unix_seconds("start"), F.unix_seconds("fired")).collect()
    assert sorted(map(tuple, got)) == [(s, a, f) for s, a, _, _, f in episodes(rows, 120, gap)]


def test_alerts_wait_for_the_watermark(spark, tmp_path):
    rows = [("s", START + 15 * i, 1.0 if i >= 10 else 0.0) for i in range(40)]
    samples = files(spark, str(tmp_path / "in"), [rows[:25], rows[25:]])
    got = closing.run_to_table(stream.sustained_stream(samples, "==", 1.0, 120, "10 minutes"), spark)
    assert got.count() == 0  # the samples are less than the delay behind the newest
    got = closing.run_to_table(stream.sustained_stream(samples, "==", 1.0, 120, "1 minute"), spark)
    assert [r["a"] - START for r in got.select(F.unix_seconds("fired").alias("a")).collect()] == [270]


def kept(query):
    return query.lastProgress["stateOperators"][-1]["numRowsTotal"]


def test_idle_series_leave_no_state(spark, tmp_path):
    idle = [("good", START + 15 * i, 0.0) for i in range(20)] + [("bad", START + 15 * i, 1.0) for i in range(20)]
    later = [("other", START + 86400 + 15 * i, 0.0) for i in range(3)]
    for gap, most in ((600, 0), (None, 1)):
        folder = str(tmp_path / f"in{gap}")
        feed = closing.Closable(spark, files(spark, folder, [idle, later]), "ts")
        before = spark.conf.get(closing.STATE_STORE)
        spark.conf.set(closing.STATE_STORE, closing.ROCKS)
        for again in (False, True):
            if again:
                feed.close()
            query = (
                stream.sustained_stream(feed.rows, "==", 1.0, 120, "1 minute", gap).writeStream.format("noop")
                .option("checkpointLocation", str(tmp_path / f"state{gap}")).trigger(availableNow=True).start()
            )
            query.awaitTermination()
        spark.conf.set(closing.STATE_STORE, before)
        assert kept(query) == most, gap


def test_calls_to_the_state_store_do_not_grow_with_the_samples(monkeypatch):
    """A stand-in for the state store counts the calls that one batch of a series takes."""
    calls, timers = [], []

    class Waiting:
        rows: list = []

        def __getattr__(self, name):  # a state variable of another kind would be called by other names
            def call(*args):
                calls.append(name)
                if name == "appendValue":
                    self.rows.append(args[0])
                elif name == "get":
                    return iter(list(self.rows))
                elif name == "clear":
                    self.rows.clear()
            return call

    class Handle:
        def __getattr__(self, name):
            return (lambda at: timers.append(at)) if name == "registerTimer" else lambda *_: Waiting()

    class Run:
        def get(self):
            return None

        def update(self, value):
            calls.append("update")

    class Times:
        def getCurrentWatermarkInMs(self):
            return (START + 1500) * 1000

    times = pd.to_datetime([START + i for i in range(2000)][::-1], unit="s")
    samples = pd.DataFrame({"ts": times.astype("datetime64[ns]"), "bad": True})
    processor = stream.SustainedAlerts(60 * 1_000_000, None)
    processor.init(Handle())
    processor.run = Run()
    monkeypatch.setattr(stream, "PACKED", 10_000)
    assert list(processor.handleInputRows(("s",), iter([samples]), None)) == []
    assert len(calls) == 1 and timers == [START * 1000]
    (found,) = processor.handleExpiredTimer(("s",), Times(), None)
    assert found["fired"].astype("int64").tolist() == [(START + 60) * 1_000_000]
    assert len(calls) <= 5 and timers[-1] == (START + 1501) * 1000


def test_summed_series(spark, tmp_path):
    name, metric, _, limit, hold, summed = next(r for r in fv.ALERT_RULES if r[5])
    assert summed
    half = limit / 2 + 1
    rows = [
        (f'{metric}{{shard="{k}"}}', START + 60 * i, half if 10 <= i < 30 else 1.0) for i in range(40) for k in range(2)
    ]
    rows += [("other_metric", START + 60 * i, 2 * limit) for i in range(40)]
    rows = shuffled_within(rows, 100, 2)
    feed = closing.Closable(spark, files(spark, str(tmp_path / "in"), [rows[:50], rows[50:]]), "ts")
    rule = next(r for r in fv.ALERT_RULES if r[0] == name)
    got = closing.run_to_table(stream.rule_stream(feed.rows, rule, "5 minutes"), spark, close=feed.close)
    got = got.select("rule", "series", F.unix_seconds("start"), F.unix_seconds("fired")).collect()
    assert [tuple(r) for r in got] == [(name, metric, START + 600, START + 600 + hold)]
    batch = serving.alert_rules(frame(spark, rows))
    assert [(r["rule"], r["samples"]) for r in batch.collect()] == [(name, 20)]


def test_a_closed_stream_gives_its_last_windows(spark, tmp_path):
    rows = [("s", START + 60 * i, 1.0) for i in range(30)]
    feed = closing.Closable(spark, files(spark, str(tmp_path / "in"), [rows[:20], rows[20:]]), "ts")
    outcomes = feed.rows.select(
        "ts", F.lit(200).alias("status"), F.col("value").alias("latency_ms"), F.lit(True).alias("schema_valid"),
        F.lit(True).alias("request_id"),
    )
    got = closing.run_to_table(stream.windowed_load(outcomes, "10 minutes"), spark, close=feed.close)
    assert got.agg(F.sum("requests")).first()[0] == 30


def test_alert_runs_join_across_pieces(spark):
    rng = random.Random(9)
    bad = [rng.random() < 0.85 for _ in range(2000)]
    rows = [("s", START + 15 * i, 1.0 if b else 0.0) for i, b in enumerate(bad)]
    want, start = [], None
    for i, b in enumerate(bad + [False]):
        if b and start is None:
            start = i
        if not b and start is not None:
            if (i - 1 - start) * 15 >= 120:
                want.append((START + 15 * start, START + 15 * (i - 1), i - start))
            start = None
    got = serving.sustained_alerts(frame(spark, rows), "==", 1.0, 120, piece_rows=40).select(
        F.unix_seconds("start"), F.unix_seconds("end"), "samples").collect()
    assert sorted(map(tuple, got)) == want


def test_streams_follow_state_over_several_files(spark, tmp_path):
    rows = [("s", 15 * i, 1.0 if 10 <= i < 40 or i >= 60 else 0.0) for i in range(80)]
    parts = [rows[20 * part : 20 * (part + 1)] for part in range(4)]
    feed = closing.Closable(spark, files(spark, str(tmp_path / "in"), parts), "ts")
    fired = closing.run_to_table(stream.sustained_stream(feed.rows, "==", 1.0, 120), spark, close=feed.close)
    got = fired.select(F.unix_seconds("start"), F.unix_seconds("fired")).collect()
    assert sorted(map(tuple, got)) == [(150, 270), (900, 1020)]
