"""JSON Lines readers with line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaykit import schemas
from assaykit.functions import strict_json as sj
from assaykit.functions.text import strip_text
from assaykit.operators.scoring import default_id
from assaykit.session import durable, small_side


def read_lines(
    spark: SparkSession, path: str, skip_blank: bool = False, across_files: bool = False
) -> DataFrame:
    """Text lines as (source_file, line_no, line); numbers start at 1 in every file.

    With ``across_files`` the files of a folder are counted through in name order.

    A file split is read by one task in order, so the id Spark gives each row counts up by one
    inside a split. The first id and the number of lines per split, one record each, turn that
    into line numbers; the lines themselves are not shuffled or sorted. With ``skip_blank`` only
    lines with text are returned, with their ``position`` among those lines.
    """
    scan = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    numbered = _numbered(scan, "__row", "line_no", across_files)
    if not skip_blank:
        return numbered.select("source_file", "line_no", "line")
    used = scan.where(F.length(strip_text(F.col("line"))) > 0).withColumn(
        "__used", F.monotonically_increasing_id()
    )
    lines = _numbered(used, "__used", "position", across_files)
    starts = _block_starts(scan, "__row", across_files).select(
        "source_file", "__block", (F.col("__before") - F.col("__first") + 1).alias("__shift")
    )
    return lines.join(small_side(starts), ["source_file", "__block"]).select(
        "source_file", (F.col("__row") + F.col("__shift")).alias("line_no"), "position", "line"
    )


def _block_starts(rows: DataFrame, row: str, across_files: bool) -> DataFrame:
    blocks = rows.groupBy("source_file", "__block").agg(
        F.min(row).alias("__first"), F.count(F.lit(1)).alias("__lines")
    )
    # One record per file split, so even the order over all files is a small table.
    order = (
        Window.orderBy("source_file", "__block")
        if across_files
        else Window.partitionBy("source_file").orderBy("__block")
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("__before", F.coalesce(F.sum("__lines").over(before), F.lit(0)))
    return durable(starts)


def _numbered(rows: DataFrame, row: str, out: str, across_files: bool) -> DataFrame:
    starts = _block_starts(rows, row, across_files)
    return rows.join(small_side(starts), ["source_file", "__block"]).withColumn(
        out, F.col("__before") + F.col(row) - F.col("__first") + 1
    ).drop("__before", "__first", "__lines")


def bad_encodings(spark: SparkSession, path: str) -> DataFrame:
    """Lines whose bytes are not valid UTF-8."""
    return (
        read_lines(spark, path)
        .where(~F.is_valid_utf8("line"))
        .select("source_file", "line_no")
    )


def parse_predictions(lines: DataFrame) -> DataFrame:
    """Prediction rows from lines; blank lines were skipped.

    ``lines`` comes from ``read_lines(..., skip_blank=True)``. Adds ``problem`` (null when usable)
    and typed columns; a row without an id gets one from its position.
    """
    parsed = sj.with_object(lines, "line", "row")
    row = F.col("row_object")

    def has(name: str):
        return F.try_variant_get(row, f"$.{name}", "variant").isNotNull()

    problem = (
        F.when(~F.col("row_strict"), F.coalesce("row_error", F.lit("not one JSON object")))
        .when(~has("expected"), "missing expected output")
        .when(~has("prediction"), "missing prediction text")
    )
    typed = F.from_json(F.col("line"), schemas.struct(schemas.GENERATED))
    return parsed.withColumn("problem", problem).withColumn("__t", typed).select(
        "source_file", "line_no", "position", "problem",
        default_id(F.col("__t.id"), F.col("position")).alias("id"),
        *[F.col(f"__t.{f.name}").alias(f.name)
          for f in schemas.struct(schemas.GENERATED).fields if f.name != "id"],
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return parse_predictions(read_lines(spark, path, skip_blank=True))


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Prepared records of one split's file or folder, with their line as ``position`` (0-based)."""
    record = F.from_json("line", schemas.struct(schemas.PREPARED))
    return read_lines(spark, path, across_files=True).select(
        "source_file", (F.col("line_no") - 1).alias("position"), record.alias("r"), "line"
    ).select("source_file", "position", "r.*", "line")


def expected_of(prepared: DataFrame) -> DataFrame:
    """(id, expected): the stored object, else the one in the last completion message."""
    answer = F.element_at("completion", -1)["content"]
    members = sj.members_of(sj.parse_object(answer))
    stored = F.when(members.isNotNull(), sj.output_members(members))
    return prepared.select("id", F.coalesce(F.col("expected"), stored).alias("expected"))
