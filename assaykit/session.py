"""Session helpers: time zone, reliable checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; sizing stays with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers once per application.

    Arrow UDFs import it there, and a driver started from another folder is not enough for that.
    """
    context = spark.sparkContext
    if getattr(context, "_assaykit_sent", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="assaykit-"), "assaykit.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    context._assaykit_sent = True


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what a Python worker holds at once when rows carry whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make one only for a local session without it."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = context.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="assaykit-checkpoint-")
    context.setCheckpointDir(shared)


def small_side(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """Broadcast a join side after counting that it is small; otherwise leave it to a shuffle.

    The count stops at the limit. Use it where the other side is large and wide, so that
    shuffling it would cost more than this look at the small side.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def durable(df: DataFrame) -> DataFrame:
    """Write a compact intermediate table once, so that later passes do not redo its input."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def few_parts(df: DataFrame, rows: int, part_rows: int = 100_000) -> DataFrame:
    """In no more partitions than a narrow table of at most so many rows needs."""
    return df.coalesce(1 + rows // part_rows)


def small_if(df: DataFrame, rows: int, most_rows: int = 1_000_000) -> DataFrame:
    """``small_side`` of a table known to have at most so many rows."""
    return F.broadcast(df) if rows <= most_rows else df
