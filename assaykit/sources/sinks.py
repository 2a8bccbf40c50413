"""Writers: ordered split lines, write-once tables, idempotent publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_split_lines(lines: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write (split, position, line) as text: a folder per split and slice of positions.

    Each slice is one file in order of position, and folder names sort in that order, so the number
    of tasks follows the rows.
    """
    number = F.floor(F.col("position") / rows_per_file).cast("long")
    sliced = lines.withColumn("slice", F.lpad(number.cast("string"), 12, "0"))
    slices = sliced.select("split", "slice").distinct().count()
    (
        sliced.repartition(max(1, slices), "split", "slice")
        .sortWithinPartitions("split", "slice", "position")
        .select("split", "slice", "line")
        .write.partitionBy("split", "slice")
        .text(path)
    )


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """(missing, extra) row counts between two tables, as multisets.

    Rows are counted per value on both sides and matched once, so copies do not multiply.
    """
    columns = left.columns
    text = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    key = F.sha2(text, 256).alias("row_key")
    sides = left.select(key, F.lit(1).alias("side")).unionByName(
        right.select(*columns).select(key, F.lit(-1).alias("side"))
    )
    net = sides.groupBy("row_key").agg(F.sum("side").alias("net"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("net", F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(-F.col("net"), F.lit(0))), F.lit(0)).alias("extra"),
    )


def write_once(df: DataFrame, path: str) -> bool:
    """Write a table that must never change.

    Returns True when it was written. An identical table already there is left alone; a
    different one is refused.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(hadoop):
        difference = same_rows(df, spark.read.parquet(path)).first()
        if difference["missing"] or difference["extra"]:
            raise FileExistsError(f"a different table is already published at {path}")
        return False
    df.write.mode("errorifexists").parquet(path)
    return True


def publish_predictions(df: DataFrame, path: str) -> bool:
    """Publish prediction rows once; a rerun that differs only in latency counts as the same."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(hadoop):
        there = spark.read.parquet(path).drop("latency_ms")
        difference = same_rows(df.drop("latency_ms"), there).first()
        if difference["missing"] or difference["extra"]:
            raise FileExistsError(f"other predictions are already published at {path}")
        return False
    df.write.mode("errorifexists").parquet(path)
    return True


def write_report(rows: DataFrame, path: str) -> None:
    """Score, metric or decision rows as JSON lines."""
    rows.write.mode("errorifexists").json(path)
