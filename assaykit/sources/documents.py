"""Single-document JSON files: manifests, freezes, reviewer packets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import schemas


def read_document(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One row per file with its path and the document's columns."""
    text = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("document")
    )
    parsed = F.from_json("document", schemas.struct(ddl))
    return text.select("path", F.sha2("document", 256).alias("sha256"), parsed.alias("d")).select(
        "path", F.col("sha256").alias("file_sha256"), "d.*"
    )


def manifest_ids(manifest: DataFrame) -> DataFrame:
    """(split, position, id) rows of a dataset manifest."""
    return manifest.select(F.explode("split_ids").alias("split", "ids")).select(
        "split", F.posexplode("ids").alias("position", "id")
    )


def manifest_splits(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("splits").alias("split", "a")).select(
        "split", F.col("a.file").alias("file"), F.col("a.count").alias("rows"),
        F.col("a.sha256").alias("sha256"),
    )


def manifest_labels(manifest: DataFrame) -> DataFrame:
    """(split, dimension, label, rows) rows of a dataset manifest."""
    return (
        manifest.select(F.explode("splits").alias("split", "a"))
        .select("split", F.explode("a.labels").alias("dimension", "labels"))
        .select("split", "dimension", F.explode("labels").alias("label", "rows"))
    )


def packet_decisions(packets: DataFrame) -> DataFrame:
    """Reviewer packets as (path, position, record_id, outcomes) rows."""
    return packets.select("path", F.posexplode("decisions").alias("position", "d")).select(
        "path", "position", "d.*"
    )


def freeze_ids(freeze: DataFrame) -> DataFrame:
    return freeze.select(F.posexplode("held_out_ids").alias("position", "id"))


def review_version(documents: DataFrame, text: str) -> DataFrame:
    """Schema version of review manifests, read before choosing their reader."""
    version = F.get_json_object(text, "$.schema_version")
    return documents.withColumn("schema_version", version).withColumn(
        "reader",
        F.when(version == "1.1", "legacy").when(version == "1.2", "current").otherwise("unsupported"),
    )
