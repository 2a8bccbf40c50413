"""Chat records: shape checks and the prompt/completion projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions.digests import lower_escapes
from assaykit.functions.text import strip_field
from assaykit.operators.duplicates import lookup_by_group


def prompt_completion(record: Column) -> list[Column]:
    """Columns of a prepared record: the first two messages prompt for the rest."""
    messages = record["messages"]
    return [
        record["id"].alias("id"),
        F.slice(messages, 1, 2).alias("prompt"),
        F.slice(messages, F.lit(3), F.greatest(F.size(messages) - 2, F.lit(0))).alias("completion"),
        record["expected"].alias("expected"),
        record["provenance"].alias("provenance"),
        record["pii_placeholders"].alias("pii_placeholders"),
    ]


def prepared_json(row: dict[str, Column] | None = None) -> Column:
    """Canonical JSON line of a prepared record: every object has its keys in sorted order."""
    get = (row or {}).get

    def column(name: str) -> Column:
        found = get(name)
        return F.col(name) if found is None else found

    def messages(name: str) -> Column:
        return F.transform(
            column(name), lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))
        )

    expected, provenance = column("expected"), column("provenance")
    line = F.to_json(
        F.struct(
            messages("completion").alias("completion"),
            F.struct(
                *[
                    expected[k].alias(k)
                    for k in ("category", "next_action", "priority", "response", "sentiment")
                ]
            ).alias("expected"),
            column("id").alias("id"),
            column("pii_placeholders").alias("pii_placeholders"),
            messages("prompt").alias("prompt"),
            F.struct(
                *[
                    provenance[k].alias(k)
                    for k in ("contains_real_customer_data", "created_by", "license", "source")
                ]
            ).alias("provenance"),
        ),
        {"ignoreNullFields": "false"},
    )
    return lower_escapes(line)


def conversation_shape(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Per conversation: turn count, contiguous turns, system turns only first, roles that
    alternate, and whether the assistant speaks last. Turns are summed up, never collected.
    """
    length = F.length(strip_field(F.col(text)))
    # With turns numbered from 0 without gaps, roles alternate exactly when user and assistant
    # sit on fixed parities, shifted by one after a system turn.
    parity = F.pmod(F.col(turn), F.lit(2))
    return (
        turns.groupBy(conv)
        .agg(
            F.count(F.lit(1)).alias("turns"),
            F.min(turn).alias("__first"),
            F.max(turn).alias("__last"),
            F.count_if(F.col(role) == "system").alias("system_turns"),
            F.count_if((F.col(role) == "system") & (F.col(turn) > 0)).alias("late_system_turns"),
            F.count_if((F.col(role) == "user") & (parity == 0)).alias("__u0"),
            F.count_if((F.col(role) == "user") & (parity == 1)).alias("__u1"),
            F.count_if((F.col(role) == "assistant") & (parity == 0)).alias("__a0"),
            F.count_if((F.col(role) == "assistant") & (parity == 1)).alias("__a1"),
            F.max_by(role, turn).alias("last_role"),
            F.count_if(~length.between(1, 8000)).alias("bad_lengths"),
        )
        .select(
            conv,
            "turns",
            ((F.col("__first") == 0) & (F.col("__last") == F.col("turns") - 1)).alias("contiguous"),
            "system_turns",
            "late_system_turns",
            (
                ((F.col("__u0") == 0) & (F.col("__a1") == 0))
                | ((F.col("__u1") == 0) & (F.col("__a0") == 0))
            ).alias("alternating"),
            (F.col("last_role") == "assistant").alias("ends_with_assistant"),
            "bad_lengths",
        )
    )


def last_answer_split(turns: DataFrame, conv: str, turn: str, role: str) -> DataFrame:
    """Turns with ``part``: ``completion`` for the last assistant turn, ``prompt`` before it.

    Turns after the last answer, and conversations without one, have no part and are dropped.
    Turns stay rows, so a very long conversation is never one value.
    """
    last = turns.groupBy(conv).agg(
        F.max(F.when(F.col(role) == "assistant", F.col(turn))).alias("__answer"),
        F.count(F.lit(1)).alias("__turns"),
    )
    part = F.when(F.col(turn) == F.col("__answer"), "completion").when(
        F.col(turn) < F.col("__answer"), "prompt"
    )
    return (
        lookup_by_group(turns, last, conv, "__turns")
        .withColumn("part", part)
        .where(F.col("part").isNotNull())
        .drop("__answer", "__turns")
    )
