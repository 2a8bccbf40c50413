"""Records of the engine's own shapes, derived from the given tables by Spark.

Labels, wordings and faults follow from a row's numbers, so that each registered query has an
equivalent in SQL. Every derivation covers the whole table and the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions.stages import with_computed
from assaykit.tables import read_table

SYSTEM_TEXT = "Sort the ticket. Answer with one JSON object."
_JSON_ORDER = ("category", "next_action", "priority", "response", "sentiment")


def label(labels: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), index.cast("int") + 1)


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with three labels."""
    docs = read_table(spark, folder, "documents", spread=True)
    return docs.select(
        "doc_id",
        "text",
        "lang",
        "source",
        label(fv.CATEGORIES, F.col("n_chars") % 7).alias("category"),
        label(fv.PRIORITIES, F.col("doc_id") % 4).alias("priority"),
        label(fv.SENTIMENTS, F.floor(F.col("doc_id") / 4) % 5).alias("sentiment"),
        "n_chars",
    )


def record_id(doc_id: Column) -> Column:
    return F.format_string("DOC-%08d", doc_id)


def _object(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[fields[k].alias(k) for k in _JSON_ORDER if k in fields]))


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(line_no, line): one chat record per document as JSON text, some of them faulty."""
    fault = F.col("doc_id") % 40

    def broken(number: int, bad: Column, good: Column) -> Column:
        return F.when(fault == number, bad).otherwise(good)

    t = tickets(spark, folder)
    doc = F.col("doc_id")
    ident = broken(5, F.lower(record_id(doc)), broken(19, record_id(doc - 1), record_id(doc)))
    priority_index = doc % 4
    expected = {
        "category": broken(8, F.lit("other"), F.col("category")),
        "priority": F.col("priority"),
        "sentiment": F.col("sentiment"),
        "response": broken(
            9, F.lit("too short"),
            F.concat(F.lit("We look into record "), doc.cast("string"), F.lit(" and reply.")),
        ),
        "next_action": broken(10, F.lit("Review Ticket"), F.lit("review_ticket")),
    }
    answer = dict(expected)
    answer["priority"] = broken(14, label(fv.PRIORITIES, (priority_index + 1) % 4), F.col("priority"))
    answer_text = _object(answer)
    assistant = broken(15, F.concat(F.lit("```json\n"), answer_text, F.lit("\n```")), answer_text)
    user = broken(16, F.col("text"), F.concat(F.col("text"), F.lit(" [DOC_ID]")))

    def message(role: Column, content: Column) -> Column:
        return F.struct(role.alias("role"), content.alias("content"))

    first = message(
        broken(7, F.lit("user"), F.lit("system")),
        broken(13, F.lit(SYSTEM_TEXT + "!"), F.lit(SYSTEM_TEXT)),
    )
    second = message(broken(7, F.lit("system"), F.lit("user")), user)
    third = message(F.lit("assistant"), assistant)
    record = F.struct(
        ident.alias("id"),
        broken(6, F.array(first, second), F.array(first, second, third)).alias("messages"),
        F.struct(*[expected[k].alias(k) for k in fv.OUTPUT_FIELDS]).alias("expected"),
        F.struct(
            F.lit("synthetic").alias("source"),
            F.lit("table generator").alias("created_by"),
            broken(11, F.lit("MIT"), F.lit("CC0-1.0")).alias("license"),
            F.lit(False).alias("contains_real_customer_data"),
        ).alias("provenance"),
        broken(
            12, F.array(F.lit("[DOC_ID]"), F.lit("[SPARE_ID]")), F.array(F.lit("[DOC_ID]"))
        ).alias("pii_placeholders"),
    )
    # made once, as every branch below would hold all of its code
    t = with_computed(t, {"good": F.to_json(record)})
    good = F.col("good")
    rest = F.substr(good, F.lit(2))
    line = (
        F.when(fault == 1, F.lit("   "))
        .when(fault == 2, F.substr(good, F.lit(1), F.length(good) - 1))
        .when(fault == 3, F.concat(F.lit('{"id":"X",'), rest))
        .when(fault == 4, F.concat(F.lit('{"extra":1,'), rest))
        .when(fault == 17, F.regexp_replace(good, '"id":"[^"]*"', '"id":7'))
        .otherwise(good)
    )
    return t.select((doc + 1).alias("line_no"), line.alias("line"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Faultless chat records with the whole document as user text."""
    t = tickets(spark, folder)
    doc = F.col("doc_id")
    expected = {
        "category": F.col("category"),
        "priority": F.col("priority"),
        "sentiment": F.col("sentiment"),
        "response": F.concat(F.lit("We look into record "), doc.cast("string"), F.lit(" and reply.")),
        "next_action": F.lit("review_ticket"),
    }

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return t.select(
        record_id(doc).alias("id"),
        F.array(
            message("system", F.lit(SYSTEM_TEXT)),
            message("user", F.concat(F.col("text"), F.lit(" [DOC_ID]"))),
            message("assistant", _object(expected)),
        ).alias("messages"),
        F.struct(*[expected[k].alias(k) for k in fv.OUTPUT_FIELDS]).alias("expected"),
        F.struct(
            F.lit("synthetic").alias("source"),
            F.lit("table generator").alias("created_by"),
            F.lit("CC0-1.0").alias("license"),
            F.lit(False).alias("contains_real_customer_data"),
        ).alias("provenance"),
        F.array(F.lit("[DOC_ID]")).alias("pii_placeholders"),
    )


def predictions(spark: SparkSession, folder: str, salt: int = 0) -> DataFrame:
    """(id, position, expected, prediction, latency_ms): one answer per document.

    The document is the response text. ``shape`` picks one of 16 ways to answer: right and bare,
    one label wrong, fenced, in prose, repeated key, NaN, cut off, a field missing, unknown
    field, null field, unknown label, plain text, or inside an array.
    """
    t = tickets(spark, folder).withColumn("shape", (F.col("doc_id") * 31 + F.col("n_chars") + salt) % 16)
    shape = F.col("shape")
    doc = F.col("doc_id")
    said = {
        "category": F.when(shape == 12, "other")
        .when(shape == 1, label(fv.CATEGORIES, (F.col("n_chars") + 1) % 7))
        .otherwise(F.col("category")),
        "priority": F.when(shape == 2, label(fv.PRIORITIES, (doc + 1) % 4)).otherwise(F.col("priority")),
        "sentiment": F.when(
            shape == 3, label(fv.SENTIMENTS, (F.floor(doc / 4) + 1) % 5)
        ).otherwise(F.col("sentiment")),
        "response": F.col("text"),
        "next_action": F.lit("review_ticket"),
    }
    whole = _object(said)
    rest = F.substr(whole, F.lit(2))
    text = (
        F.when(shape == 4, F.concat(F.lit("Answer:\n```json\n"), whole, F.lit("\n```")))
        .when(shape == 5, F.concat(F.lit("Result: "), whole, F.lit(" done")))
        .when(shape == 6, F.concat(F.lit('{"category":"bug",'), rest))
        .when(shape == 7, F.concat(F.lit('{"x":NaN,'), rest))
        .when(shape == 8, F.substr(whole, F.lit(1), F.length(whole) - 1))
        .when(shape == 9, _object({k: v for k, v in said.items() if k != "response"}))
        .when(shape == 10, F.concat(F.lit('{"note":1,'), rest))
        .when(shape == 11, F.concat(F.lit('{"note":null,'),
                                    F.replace(rest, F.lit('"next_action":"review_ticket"'),
                                              F.lit('"next_action":null'))))
        .when(shape == 13, F.col("text"))
        .when(shape == 14, F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise(whole)
    )
    right = {**said, "category": F.col("category"), "priority": F.col("priority"),
             "sentiment": F.col("sentiment")}
    return t.select(
        record_id(doc).alias("id"),
        doc.alias("position"),
        F.struct(*[right[k].alias(k) for k in fv.OUTPUT_FIELDS]).alias("expected"),
        text.alias("prediction"),
        (F.col("n_chars") % 977 + (doc % 8) / 8.0).cast("double").alias("latency_ms"),
        "shape",
    )


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as request outcomes."""
    events = read_table(spark, folder, "events")
    failed = F.col("event_type") == "error"
    return events.select(
        "event_id",
        "ts",
        "event_type",
        F.when(failed & (F.col("user_id") % 3 == 0), 0)
        .when(failed, 500 + F.col("user_id") % 4)
        .otherwise(200)
        .cast("int")
        .alias("status"),
        F.col("value").alias("latency_ms"),
        (~failed & (F.col("user_id") % 10 != 0)).alias("schema_valid"),
        (F.col("user_id") % 20 != 0).alias("request_id"),
        F.when(failed & (F.col("user_id") % 3 == 0), "connection_failed")
        .when(failed, "http_error")
        .alias("error_code"),
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Mean event value per event type and hour, as metric series."""
    events = read_table(spark, folder, "events")
    return events.groupBy(
        F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("ts")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))


# The same derivations in SQL, as parts of WITH clauses.
SQL_LABELS = {
    "category": "[" + ", ".join(f"'{x}'" for x in fv.CATEGORIES) + "]",
    "priority": "[" + ", ".join(f"'{x}'" for x in fv.PRIORITIES) + "]",
    "sentiment": "[" + ", ".join(f"'{x}'" for x in fv.SENTIMENTS) + "]",
}
SQL_TICKETS = f"""tickets AS (
  SELECT doc_id, text, lang, source, n_chars,
         {SQL_LABELS['category']}[CAST(n_chars % 7 AS INTEGER) + 1] AS category,
         {SQL_LABELS['priority']}[CAST(doc_id % 4 AS INTEGER) + 1] AS priority,
         {SQL_LABELS['sentiment']}[CAST((doc_id // 4) % 5 AS INTEGER) + 1] AS sentiment
  FROM documents)"""


def sql_fingerprint(text: str) -> str:
    return (
        f"sha256(trim(regexp_replace(replace(lower({text}), 'ß', 'ss'), "
        r"'[^\p{L}\p{N}_]+', ' ', 'g')))"
    )


SQL_PII = {
    "email address": r"(?i)(^|[^a-z0-9_\p{L}\p{N}])[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}([^\p{L}\p{N}_]|$)",
    "US social-security number": r"(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}([^0-9]|$)",
    "payment-card-like number": r"(^|[^0-9])([0-9][ -]?){12,18}[0-9]([^0-9]|$)",
    "phone-like number": r"(^|[^\p{L}\p{N}_.])\+?([0-9][\s().-]*){7,14}[0-9]([^\p{L}\p{N}_.]|$)",
}


def sql_pii(text: str) -> dict[str, str]:
    return {name: f"regexp_matches({text}, '{pattern}')" for name, pattern in SQL_PII.items()}


def sql_any_pii(text: str) -> str:
    return "(" + " OR ".join(sql_pii(text).values()) + ")"


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_predictions(name: str, salt: int = 0) -> str:
    """A scored-row CTE: what each shape of answer yields."""
    c, p, s = (SQL_LABELS[k] for k in ("category", "priority", "sentiment"))
    trimmed = sql_strip("text")
    return f"""{name}_shaped AS (
  SELECT *, (doc_id * 31 + n_chars + {salt}) % 16 AS shape FROM tickets),
{name}_said AS (
  SELECT *,
    shape NOT IN (6, 7, 8, 13) AS found,
    shape NOT IN (4, 5, 6, 7, 8, 13, 14) AS strict,
    CASE WHEN shape = 12 THEN 'other'
         WHEN shape = 1 THEN {c}[CAST((n_chars + 1) % 7 AS INTEGER) + 1]
         ELSE category END AS said_category,
    CASE WHEN shape = 2 THEN {p}[CAST((doc_id + 1) % 4 AS INTEGER) + 1] ELSE priority END AS said_priority,
    CASE WHEN shape = 3 THEN {s}[CAST((doc_id // 4 + 1) % 5 AS INTEGER) + 1] ELSE sentiment END AS said_sentiment,
    length({trimmed}) BETWEEN 12 AND 1200 AS fits,
    {sql_any_pii(trimmed)} AS leaks
  FROM {name}_shaped),
{name}_errors AS (
  SELECT *,
    CASE WHEN NOT found THEN NULL ELSE
      (CASE WHEN shape = 12 THEN 1 ELSE 0 END)
      + (CASE WHEN shape = 9 OR NOT fits THEN 1 ELSE 0 END)
      + (CASE WHEN shape IN (10, 11) THEN 1 ELSE 0 END)
      + (CASE WHEN shape = 11 THEN 1 ELSE 0 END) END AS errors
  FROM {name}_said),
{name} AS (
  SELECT doc_id, printf('DOC-%08d', doc_id) AS id, doc_id AS position, shape,
    category, priority, sentiment, text,
    CASE WHEN shape = 6 THEN 'duplicate JSON object key: ''category'''
         WHEN shape = 7 THEN 'non-finite JSON constant is not permitted: NaN'
         WHEN NOT found THEN 'no JSON object found'
         WHEN NOT strict THEN 'output is not one bare JSON object'
         WHEN errors > 0 THEN 'schema validation failed: ' || errors || ' error(s)'
         ELSE '' END AS parse_error,
    strict AS strict_json_only,
    strict AND errors = 0 AS schema_valid,
    CASE WHEN NOT found THEN 0.0
         WHEN shape = 9 OR shape = 11 OR length(text) = 0 THEN 4 / 5.0 ELSE 1.0 END AS field_completeness,
    found AND said_category = category AS category_correct,
    found AND said_priority = priority AS priority_correct,
    found AND said_sentiment = sentiment AS sentiment_correct,
    found AND shape <> 9 AND fits AND NOT leaks AS response_policy_compliant,
    strict AND errors = 0 AND said_category = category AND said_priority = priority
      AND said_sentiment = sentiment AS exact_match,
    CASE WHEN found THEN said_category END AS predicted_category,
    CASE WHEN found THEN said_priority END AS predicted_priority,
    CASE WHEN found THEN said_sentiment END AS predicted_sentiment,
    CAST(n_chars % 977 AS DOUBLE) + (doc_id % 8) / 8.0 AS latency_ms
  FROM {name}_errors)"""


SQL_OUTCOMES = """outcomes AS (
  SELECT event_id, ts, event_type, value AS latency_ms,
    CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 0
         WHEN event_type = 'error' THEN 500 + user_id % 4 ELSE 200 END AS status,
    event_type <> 'error' AND user_id % 10 <> 0 AS schema_valid,
    user_id % 20 <> 0 AS request_id,
    CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'connection_failed'
         WHEN event_type = 'error' THEN 'http_error' END AS error_code
  FROM events)"""
SQL_SAMPLES = """samples AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, CAST(count(*) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""
