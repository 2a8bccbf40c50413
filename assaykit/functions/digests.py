"""Canonical JSON and digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_OUT = 4096


def lower_escapes(json: Column) -> Column:
    """JSON text with control characters written as \\u001f, as canonical bytes want them.

    ``to_json`` writes \\u001F. A backslash that stands for itself is written twice; such pairs are
    set aside first, as a character that JSON text cannot hold, so that what follows them stays.
    """
    aside = F.replace(json, F.lit("\\\\"), F.lit("\x01"))
    for code in (0x0B, *range(0x0E, 0x10), *range(0x1A, 0x20)):
        aside = F.replace(aside, F.lit(f"\\u{code:04X}"), F.lit(f"\\u{code:04x}"))
    lowered = F.replace(aside, F.lit("\x01"), F.lit("\\\\"))
    return F.when(F.contains(json, F.lit("\\u00")), lowered).otherwise(json)


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON object with sorted keys; nulls are kept, text is not escaped to ASCII."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return lower_escapes(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}))


def canonical_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def run_id(created_at: Column, config_digest: Column) -> Column:
    """UTC time to the microsecond and the start of the configuration's digest."""
    stamp = F.date_format(created_at, "yyyyMMdd'T'HHmmss.SSSSSS'Z'")
    return F.concat(stamp, F.lit("-"), F.substring(config_digest, 1, 12))


def short_id(identity: dict[str, Column]) -> Column:
    """First 16 hex digits of an identity's digest, as comparison reports are named."""
    return F.substring(canonical_digest(identity), 1, 16)


def tree_digest(
    rows: DataFrame,
    group: Sequence[str],
    position: str,
    line: Column,
    fan_out: int = FAN_OUT,
    levels: int = 4,
) -> DataFrame:
    """One digest per group over its ordered lines.

    Lines are hashed one by one; ``fan_out`` consecutive digests are joined by line feeds and
    hashed into the next level, ``levels`` times, or more often where the greatest position needs
    it to leave one node per group. No task holds more than ``fan_out`` digests. The result depends
    on the content and order of the lines only, not on files or partitions.
    """
    if not group:
        whole = tree_digest(
            rows.withColumn("__all", F.lit(0)), ["__all"], position, line, fan_out, levels
        )
        return whole.drop("__all")
    level = rows.select(
        *group,
        F.col(position).cast("long").alias("__p"),
        F.sha2(line, 256).alias("__d"),
        F.lit(1).cast("long").alias("__n"),
    )
    last = rows.agg(F.max(F.col(position).cast("long"))).first()[0] or 0
    while fan_out**levels <= last:
        levels += 1
    for _ in range(levels):
        node = F.sort_array(F.collect_list(F.struct("__p", "__d")))
        level = (
            level.groupBy(*group, F.floor(F.col("__p") / fan_out).cast("long").alias("__q"))
            .agg(node.alias("__members"), F.sum("__n").alias("__n"))
            .select(
                *group,
                F.col("__q").alias("__p"),
                F.sha2(
                    F.array_join(F.transform("__members", lambda m: m["__d"]), "\n"), 256
                ).alias("__d"),
                "__n",
            )
        )
    return level.select(*group, F.col("__n").alias("lines"), F.col("__d").alias("digest"))
