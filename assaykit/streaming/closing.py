"""Finite streams that end with a marker row, and draining them into tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.session import ensure_checkpoint_dir

#: Event time of the marker row: behind every sample and every delay (pandas ends in 2262).
END_OF_TIME = "2200-01-01 00:00:00"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base}/{name}-{uuid.uuid4().hex}"


class Closable:
    """A stream whose last windows and alerts come out once it is closed.

    A watermark stays a delay behind the newest row, so what lies within the delay of the end never
    leaves a stateful operator. ``rows`` is the stream and, after ``close``, one more row with the
    event time ``END_OF_TIME`` and nulls elsewhere. Close only after the stream's own rows have been
    read: whatever comes later is late. Operators have to leave out the marker's own group, which is
    never closed in turn.
    """

    def __init__(self, spark: SparkSession, stream: DataFrame, ts: str):
        self.spark, self.ts, self.schema = spark, ts, stream.schema
        self.folder = shared_folder(spark, "marker")
        self._write(0)
        marker = spark.readStream.schema(self.schema).parquet(self.folder)
        self.rows = stream.unionByName(marker)

    def close(self) -> None:
        self._write(1)

    def _write(self, rows: int) -> None:
        ends = self.spark.createDataFrame(pa.table({"ts": pa.array([END_OF_TIME] * rows, pa.string())}))
        columns = [
            (F.col("ts") if f.name == self.ts else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        ends.select(*columns).write.mode("append").parquet(self.folder)


def run_to_table(
    stream: DataFrame, spark: SparkSession, mode: str = "append", close: Callable[[], None] | None = None
) -> DataFrame:
    """Drain a stream's available input into a Parquet folder and read it back.

    With ``close`` (of a Closable) the query is run once for the input, then again from its
    checkpoint for the marker. The folder, the state and the stream's checkpoint lie under the
    session's shared checkpoint folder. Operators with timers need the RocksDB state store, which
    is set for this query alone.
    """
    base = shared_folder(spark, "stream")
    before = spark.conf.get(STATE_STORE)
    for again in (False, True):
        if again:
            if close is None:
                break
            close()
        spark.conf.set(STATE_STORE, ROCKS)
        try:
            query = (
                stream.writeStream.format("parquet")
                .option("checkpointLocation", f"{base}/state")
                .option("path", f"{base}/rows")
                .outputMode(mode)
                .trigger(availableNow=True)
                .start()
            )
        finally:
            spark.conf.set(STATE_STORE, before)
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
