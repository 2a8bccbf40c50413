"""Validation rules for source records, and the violations they give.

Every rule is one Boolean column. Rules come in three tiers. A line has to parse before its
fields are checked, its fields have to hold before the record as a whole is checked, and only
valid records take part in the checks across records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit import schemas
from assaykit.functions import strict_json as sj
from assaykit.functions import text as tx
from assaykit.functions.stages import with_computed
from assaykit.operators.duplicates import repeated_rows
from assaykit.session import durable

RULES = (
    "empty_dataset",
    "not_utf8",
    "blank_line",
    "strict_json",
    "unknown_keys",
    "field_types",
    "id_pattern",
    "message_count",
    "message_role",
    "message_length",
    "category_label",
    "priority_label",
    "sentiment_label",
    "response_length",
    "next_action_pattern",
    "provenance",
    "placeholder_pattern",
    "role_order",
    "system_message",
    "assistant_json",
    "assistant_matches_expected",
    "placeholders_unique",
    "placeholder_inventory",
    "user_placeholder",
    "duplicate_id",
    "duplicate_content",
    "unredacted_pii",
)
RULE_ORDER = {name: number for number, name in enumerate(RULES)}
_TOP_KEYS = ("expected", "id", "messages", "pii_placeholders", "provenance")
_PROVENANCE_KEYS = ("contains_real_customer_data", "created_by", "license", "source")


#: Kind of messages that have no members but the two known ones, both strings or null.
_PLAIN_MESSAGES = "ARRAY<OBJECT<content: STRING, role: STRING>>"


def read_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parse lines once: strict flag, error text, VARIANT for key checks, typed record.

    A line whose members have the expected JSON types is not parsed a second time: its typed record
    is taken from the VARIANT. The rest goes through ``from_json``, which turns other types to text.
    """
    schema = schemas.struct(schemas.SOURCE)
    parsed = sj.with_object(lines, line, "json")
    variant = F.when(F.col("json_strict"), F.col("json_object"))
    staged = with_computed(parsed, {"variant": variant}).drop("json_object")
    kinds = {"kinds_hold": _kinds_hold(), "message_kind": _kind("$.messages")}
    staged = with_computed(staged, kinds)
    plain = (
        F.col("kinds_hold")
        & (F.col("message_kind") == _PLAIN_MESSAGES)
        & F.startswith(line, F.lit("{"))
        & F.endswith(line, F.lit("}"))
    )
    typed = F.when(
        plain, F.try_variant_get(F.col("variant"), "$", schema.simpleString())
    ).otherwise(F.from_json(F.when(F.col("json_strict"), F.col(line)), schema))
    return _trimmed(with_computed(staged, {"record": typed}))


def _trimmed(df: DataFrame) -> DataFrame:
    """Free text is trimmed before it is checked or stored; labels are compared as they are."""
    record = F.col("record")
    trimmed = (
        F.when(
            record.isNotNull(),
            F.struct(
                tx.strip_field(record["id"]).alias("id"),
                F.transform(
                    record["messages"],
                    lambda m: F.struct(
                        m["role"].alias("role"), tx.strip_long(m["content"]).alias("content")
                    ),
                ).alias("messages"),
                sj.trimmed_output(record["expected"]).alias("expected"),
                F.struct(
                    record["provenance"]["source"].alias("source"),
                    tx.strip_field(record["provenance"]["created_by"]).alias("created_by"),
                    record["provenance"]["license"].alias("license"),
                    record["provenance"]["contains_real_customer_data"].alias(
                        "contains_real_customer_data"
                    ),
                ).alias("provenance"),
                F.transform(record["pii_placeholders"], tx.strip_field).alias("pii_placeholders"),
            ),
        )
    )
    return with_computed(df, {"record": trimmed})


def _keys_at(path: str) -> Column:
    value = F.try_variant_get("variant", path, "variant")
    return F.json_object_keys(F.to_json(value))


def _unknown_keys() -> Column:
    def extra(keys: Column, known: tuple[str, ...]) -> Column:
        return F.coalesce(
            F.size(F.array_except(keys, F.array(*[F.lit(k) for k in known]))) > 0, F.lit(False)
        )

    messages = F.from_json(F.to_json(F.try_variant_get("variant", "$.messages", "variant")),
                           "array<string>")
    in_messages = F.when(F.col("message_kind") == _PLAIN_MESSAGES, False).otherwise(
        F.exists(messages, lambda m: extra(F.json_object_keys(m), ("role", "content")))
    )
    return (
        extra(F.map_keys(sj.members_of(F.col("variant"))), _TOP_KEYS)
        | extra(_keys_at("$.expected"), fv.OUTPUT_FIELDS)
        | extra(_keys_at("$.provenance"), _PROVENANCE_KEYS)
        | F.coalesce(in_messages, F.lit(False))
    )


def _kind(path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("variant", path, "variant"))


def _kinds_hold() -> Column:
    """JSON types of all members but the messages."""
    strings = ["$.id", "$.provenance.created_by"]
    strings += [f"$.expected.{name}" for name in fv.OUTPUT_FIELDS]
    holds = F.lit(True)
    for path in strings:
        holds = holds & F.coalesce(_kind(path) == "STRING", F.lit(False))
    for path in ("$.provenance.source", "$.provenance.license"):
        holds = holds & (_kind(path).isNull() | (_kind(path) == "STRING"))
    flag = _kind("$.provenance.contains_real_customer_data")
    holds = holds & (flag.isNull() | (flag == "BOOLEAN"))
    placeholders = _kind("$.pii_placeholders").isin("ARRAY<STRING>", "ARRAY<VOID>")
    return holds & F.coalesce(placeholders, F.lit(False))


def _types_hold() -> Column:
    """JSON types, without any coercion. Provenance members other than the author have defaults."""
    no_gap = F.forall(
        F.col("record.messages"), lambda m: m["role"].isNotNull() & m["content"].isNotNull()
    )
    message_kind = F.col("message_kind").rlike(
        r"^ARRAY<OBJECT<.*content: STRING.*role: STRING.*>>$"
    )
    return (
        F.col("kinds_hold")
        & F.coalesce(message_kind & no_gap, F.lit(False))
        & F.coalesce(
            F.forall(F.col("record.pii_placeholders"), lambda p: p.isNotNull()), F.lit(False)
        )
    )


def field_rules() -> dict[str, Column]:
    """Rules on single fields; true means the rule holds."""
    record = F.col("record")
    low, high = fv.CONTENT_LENGTH
    checks = sj.field_checks(record["expected"])
    provenance = record["provenance"]
    author_low, author_high = fv.CREATED_BY_LENGTH
    return {
        "unknown_keys": ~_unknown_keys(),
        "field_types": _types_hold(),
        "id_pattern": record["id"].rlike(fv.RECORD_ID),
        "message_count": F.size(record["messages"]) == 3,
        "message_role": F.forall(
            record["messages"], lambda m: m["role"].isin("system", "user", "assistant")
        ),
        "message_length": F.forall(
            record["messages"], lambda m: F.length(m["content"]).between(low, high)
        ),
        "category_label": checks["category"],
        "priority_label": checks["priority"],
        "sentiment_label": checks["sentiment"],
        "response_length": checks["response"],
        "next_action_pattern": checks["next_action"],
        "provenance": (F.coalesce(provenance["source"], F.lit(fv.PROVENANCE_SOURCE))
                       == fv.PROVENANCE_SOURCE)
        & (F.coalesce(provenance["license"], F.lit(fv.PROVENANCE_LICENSE)) == fv.PROVENANCE_LICENSE)
        & ~F.coalesce(provenance["contains_real_customer_data"], F.lit(False))
        & F.length(provenance["created_by"]).between(author_low, author_high),
        "placeholder_pattern": (F.size(record["pii_placeholders"]) >= 1)
        & F.forall(record["pii_placeholders"], lambda p: p.rlike(f"^{fv.PLACEHOLDER}$")),
    }


def record_rules(system_text: str) -> dict[str, Column]:
    """Rules on the record as a whole.

    ``assistant`` holds the members of the last message, ``placeholders`` those of all texts.
    """
    record = F.col("record")
    content = F.transform(record["messages"], lambda m: m["content"])
    declared, found = record["pii_placeholders"], F.col("placeholders")
    members = sj.output_members(F.col("assistant"))
    answer = sj.trimmed_output(members)
    equal = F.lit(True)
    for name in fv.OUTPUT_FIELDS:
        equal = equal & answer[name].eqNullSafe(record["expected"][name])
    json_ok = F.col("assistant").isNotNull() & F.coalesce(
        sj.field_errors(members, F.col("assistant")) == 0, F.lit(False)
    )
    return {
        "role_order": F.transform(record["messages"], lambda m: m["role"])
        == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
        "system_message": F.get(content, F.lit(0)) == system_text,
        "assistant_json": json_ok,
        "assistant_matches_expected": ~json_ok | equal,
        "placeholders_unique": F.size(declared) == F.size(F.array_distinct(declared)),
        "placeholder_inventory": (F.size(F.array_except(found, declared)) == 0)
        & (F.size(F.array_except(declared, found)) == 0),
        "user_placeholder": F.get(content, F.lit(1)).rlike(fv.PLACEHOLDER),
    }


def _broken(rules: dict[str, Column]) -> Column:
    """Names of the rules that do not hold; unknown counts as not holding."""
    return F.array_compact(
        F.array(
            *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
        )
    )


def checked_records(lines: DataFrame, system_text: str, line: str = "line") -> DataFrame:
    """Lines with the list of rules each breaks on its own (``broken``) and the typed record."""
    blank = ~F.col("json_strict") & (F.length(tx.strip_text(F.col(line))) == 0)
    read = read_records(lines, line)
    first = (
        F.when(~F.is_valid_utf8(line), F.array(F.lit("not_utf8")))
        .when(blank, F.array(F.lit("blank_line")))
        .when(~F.col("json_strict"), F.array(F.lit("strict_json")))
        .otherwise(_broken(field_rules()))
    )
    fields_checked = with_computed(read, {"__fields": first})
    record, holds = F.col("record"), F.size("__fields") == 0
    content = F.transform(record["messages"], lambda m: m["content"])
    everything = F.concat_ws("\n", content, record["expected"]["response"])
    answered = with_computed(
        fields_checked,
        {
            "assistant": F.when(
                holds, sj.members_of(sj.parse_object(F.get(record["messages"], F.lit(2))["content"]))
            ),
            "placeholders": F.when(holds, F.array_distinct(tx.placeholders(everything))),
        },
    )
    broken = F.when(F.size("__fields") > 0, F.col("__fields")).otherwise(
        _broken(record_rules(system_text))
    )
    return with_computed(answered, {"broken": broken}).drop(
        "__fields", "assistant", "placeholders", "variant", "kinds_hold", "message_kind"
    )


def conversation_text(record: Column) -> Column:
    """User and assistant text, which is what the PII scan reads."""
    return F.concat_ws(
        "\n", F.transform(F.slice(record["messages"], 2, 2), lambda m: m["content"])
    )


def place_of(rows: DataFrame) -> list[str]:
    """Columns that name and order a line: its file, where several are read, and its number."""
    return [c for c in ("source_file", "line_no") if c in rows.columns]


def violations(lines: DataFrame, system_text: str, line: str = "line") -> DataFrame:
    """All violations: (source_file if given, line_no, id, rule, rule_order, phase, detail).

    ``lines`` needs ``line_no``, and ``source_file`` when they come from several files.
    """
    return violations_of(checked_records(lines, system_text, line))


def violations_of(checked: DataFrame) -> DataFrame:
    """Violations of checked records.

    Long texts are read once; what the checks across records need (place, id, fingerprint, PII
    names) is written as a compact table.
    """
    record = F.col("record")
    valid = F.size("broken") == 0
    fingerprinted = tx.with_fingerprint(
        checked, F.when(valid, F.get(record["messages"], F.lit(1))["content"])
    )
    compact = durable(
        fingerprinted.select(
            *place_of(checked),
            record["id"].alias("id"),
            "broken",
            F.col("json_error").alias("error"),
            F.when(valid, F.col("fingerprint")).alias("fingerprint"),
            F.when(valid, tx.pii_hits(conversation_text(record))).alias("pii"),
        )
    )
    return across_records(compact)


def across_records(compact: DataFrame) -> DataFrame:
    place = place_of(compact)
    alone = compact.select(
        *place, "id", F.explode("broken").alias("rule"), F.lit(0).alias("phase"),
        F.coalesce("error", F.lit("")).alias("detail"),
    )
    valid = compact.where(F.size("broken") == 0)
    pii = valid.where(F.size("pii") > 0).select(
        *place, "id", F.lit("unredacted_pii").alias("rule"), F.lit(1).alias("phase"),
        F.array_join("pii", ", ").alias("detail"),
    )
    order = [*place, "id"]

    def seen(text: str, *before) -> Column:
        at = F.format_string(text + " on line %d", *before, F.col("first.line_no"))
        if len(place) == 1:
            return at.alias("detail")
        return F.concat(at, F.lit(" of "), F.col("first.source_file")).alias("detail")

    same_id = repeated_rows(valid.select(*order, F.col("id").alias("key")), "key", order).select(
        *place, "id", F.lit("duplicate_id").alias("rule"), F.lit(1).alias("phase"),
        seen("first seen"),
    )
    same_text = repeated_rows(valid.select(*order, "fingerprint"), "fingerprint", order).select(
        *place, "id", F.lit("duplicate_content").alias("rule"), F.lit(1).alias("phase"),
        seen("matches %s", F.col("first.id")),
    )
    nowhere = {"source_file": F.lit(""), "line_no": F.lit(0).cast("long")}
    empty = compact.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        *[nowhere[c].alias(c) for c in place], F.lit("").alias("id"),
        F.lit("empty_dataset").alias("rule"), F.lit(0).alias("phase"), F.lit("").alias("detail"),
    )
    orders = F.create_map(*[x for k, v in RULE_ORDER.items() for x in (F.lit(k), F.lit(v))])
    every = alone.unionByName(pii).unionByName(same_id).unionByName(same_text).unionByName(empty)
    return every.select(
        *place, F.coalesce("id", F.lit("")).alias("id"), "rule",
        orders[F.col("rule")].alias("rule_order"), "phase", "detail",
    )


def first_error(found: DataFrame) -> DataFrame:
    """The violation a reader would meet first: all lines are parsed before records are compared."""
    place = place_of(found)
    order = F.struct("phase", *place, "rule_order")
    return found.agg(F.min_by(F.struct(*place, "id", "rule", "detail"), order).alias("e")).where(
        F.col("e").isNotNull()
    ).select("e.*")


def rule_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(
        F.count(F.lit(1)).alias("violations"), F.min("line_no").alias("first_line")
    )


def empty_dataset(lines: DataFrame) -> DataFrame:
    """One row; ``empty`` is true when there is nothing to validate."""
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), (F.count(F.lit(1)) == 0).alias("empty")
    )


def prediction_row_problems(rows: DataFrame) -> DataFrame:
    """(id, problem) rows for values a prediction row may not have."""
    latency = F.col("latency_ms")
    bad: list[tuple[str, Column]] = [
        ("id empty", F.coalesce(F.length("id") == 0, F.lit(True))),
        ("latency not a finite non-negative number",
         latency.isNotNull() & (F.isnan(latency) | (latency < 0) | (latency == float("inf")))),
    ]
    for name in ("prompt_tokens", "generated_tokens"):
        if name in rows.columns:
            bad.append((f"{name} negative", F.coalesce(F.col(name) < 0, F.lit(False))))
    for name in rows.columns:
        if name.endswith("_sha256") and dict(rows.dtypes)[name] == "string":
            bad.append((f"{name} malformed", ~F.coalesce(F.col(name).rlike(fv.SHA256_HEX), F.lit(True))))
    found = F.array_compact(F.array(*[F.when(b, F.lit(name)) for name, b in bad]))
    return rows.select("id", F.explode(found).alias("problem"))
