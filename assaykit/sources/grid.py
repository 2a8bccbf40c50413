"""A label grid of templated chat records from a table of scenarios."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv


@dataclass(frozen=True)
class GridTexts:
    """Task texts. They are parameters; these defaults are only examples."""

    system: str = (
        "Read one support ticket and answer with a single JSON object holding the keys "
        "category, priority, sentiment, response and next_action, and nothing else."
    )
    created_by: str = "assaykit-grid"
    id_prefix: str = "GRD"
    sentiment_cues: dict[str, str] = field(
        default_factory=lambda: {
            "positive": "Thanks for all the help to date.",
            "neutral": "Here are the facts as I have them.",
            "frustrated": "This keeps coming back and it wears me out.",
            "angry": "I find this completely unacceptable.",
            "worried": "I fear what this may lead to.",
        }
    )
    priority_cues: dict[str, str] = field(
        default_factory=lambda: {
            "low": "There is no hurry at all.",
            "medium": "It slows us down, though we can work around it.",
            "high": "We cannot go on with our work until it is looked at today.",
            "urgent": "Everything is down at this very moment.",
        }
    )
    response: str = "We will look into %s and pass it on to the right team, keeping details private."


def label_grid(scenarios: DataFrame, texts: GridTexts | None = None) -> DataFrame:
    """Cross scenarios with all priorities and sentiments.

    ``scenarios``: category, variant, issue, subject, next_action, placeholders. The label lists
    are exploded from literals, so each scenario row yields 20 records where it is stored.
    """
    texts = texts or GridTexts()

    def lookup(table: dict[str, str], key):
        return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]

    crossed = scenarios.withColumn(
        "priority", F.explode(F.array(*[F.lit(p) for p in fv.PRIORITIES]))
    ).withColumn("sentiment", F.explode(F.array(*[F.lit(s) for s in fv.SENTIMENTS])))
    expected = F.struct(
        F.col("category"),
        F.col("priority"),
        F.col("sentiment"),
        F.format_string(texts.response, F.col("subject")).alias("response"),
        F.col("next_action"),
    )
    record_id = F.format_string(
        "%s-%s-%s-%s-%02d",
        F.lit(texts.id_prefix),
        lookup(fv.CATEGORY_CODES, F.col("category")),
        lookup(fv.PRIORITY_CODES, F.col("priority")),
        lookup(fv.SENTIMENT_CODES, F.col("sentiment")),
        F.col("variant"),
    )
    user = F.concat_ws(
        " ",
        lookup(texts.sentiment_cues, F.col("sentiment")),
        F.col("issue"),
        lookup(texts.priority_cues, F.col("priority")),
    )
    answer = F.to_json(
        F.struct(
            *[F.col(f"expected.{k}").alias(k)
              for k in ("category", "next_action", "priority", "response", "sentiment")]
        )
    )

    def message(role: str, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return crossed.withColumn("expected", expected).select(
        record_id.alias("id"),
        F.array(
            message("system", F.lit(texts.system)), message("user", user),
            message("assistant", answer),
        ).alias("messages"),
        "expected",
        F.struct(
            F.lit(fv.PROVENANCE_SOURCE).alias("source"),
            F.lit(texts.created_by).alias("created_by"),
            F.lit(fv.PROVENANCE_LICENSE).alias("license"),
            F.lit(False).alias("contains_real_customer_data"),
        ).alias("provenance"),
        F.col("placeholders").alias("pii_placeholders"),
    )
