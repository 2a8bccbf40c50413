"""Content inventories: path, SHA-256 and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.functions.text import local_user_path


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, with its path relative to it. Files stay below 2 GiB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    base = root.split(":", 1)[-1].rstrip("/") + "/"
    return files.select(
        F.regexp_replace(plain, "^" + _quoted(base), "").alias("path"),
        F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("size_bytes"),
    )


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in text)


def content_inventory(rows: DataFrame, path: Column, content: Column) -> DataFrame:
    """The same inventory over content held in a table."""
    return rows.select(
        path.alias("path"),
        F.sha2(content, 256).alias("sha256"),
        F.octet_length(content).cast("long").alias("size_bytes"),
    )


def inventory_diff(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """(path, status): same, changed, missing or unexpected.

    A path listed with several contents is reduced to one record and counts as changed.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        content = F.struct("sha256", "size_bytes")
        return df.groupBy("path").agg(
            F.min(content).alias(name), (F.min(content) != F.max(content)).alias(f"{name}_varies")
        )

    left, right = side(declared, "l"), side(observed, "r")
    status = (
        F.when(F.col("r").isNull(), "missing")
        .when(F.col("l").isNull(), "unexpected")
        .when((F.col("l") == F.col("r")) & ~F.col("l_varies") & ~F.col("r_varies"), "same")
        .otherwise("changed")
    )
    return left.join(right, "path", "full_outer").select("path", status.alias("status"))


def texts_with_user_paths(rows: DataFrame, path: str, text: Column) -> DataFrame:
    return rows.where(local_user_path(text)).select(path)
