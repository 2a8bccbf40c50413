"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id", "events": "event_id"}


def read_table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """A table as Spark scans it. With ``spread``, see below."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread_rows(table, KEYS[name]) if spread else table


def spread_rows(table: DataFrame, key: str) -> DataFrame:
    """Give every core rows to work on when a scan has fewer tasks than there are cores.

    That is the case for one small file of a single row group. A large table already has many
    splits and is returned as it is, without a shuffle.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table
