"""Tables written once to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from assaykit.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def written(
    df: DataFrame, name: str, by: list[str] | None = None, options: dict[str, int] | None = None
) -> DataFrame:
    """The rows as a compressed Parquet table; unlike a checkpoint it keeps wide rows small."""
    folder = new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd").options(**(options or {}))
    (writer.partitionBy(*by) if by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
