"""Registered corpus queries: fingerprints, rules, leakage, text audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.catalog import derived as d
from assaykit.functions import strict_json as sj
from assaykit.functions import text as tx
from assaykit.operators import audits, conversations, rules
from assaykit.operators import distributions as dist
from assaykit.operators import duplicates as dup
from assaykit.session import durable
from assaykit.tables import read_table

Sql = str


def dup_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread=True)
    compact = durable(tx.with_fingerprint(docs, F.col("text")).select("doc_id", "fingerprint"))
    return dup.repeated_rows(compact, "fingerprint", ["doc_id"]).select(
        "doc_id", "fingerprint", F.col("first.doc_id").alias("first_doc_id"), "copies"
    )


def pii_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread=True)
    return docs.select("doc_id", F.array_join(tx.pii_hits(F.col("text")), ", ").alias("hits")).where(
        F.col("hits") != ""
    )


def secret_redaction(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread=True)
    clean = tx.redact_secrets(F.col("text"))
    return docs.select("doc_id", "text", clean.alias("clean")).where("clean <> text").select(
        "doc_id", F.sha2("clean", 256).alias("redacted_sha256"),
        F.length("clean").cast("long").alias("redacted_chars"),
    )


def placeholder_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread=True)
    return dist.placeholder_counts(docs, tx.placeholders(tx.redact_secrets(F.col("text"))))


def source_leakage(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread=True)
    keyed = tx.with_fingerprint(docs, F.col("text")).select("fingerprint", "source")
    return dup.shared_across(keyed, "fingerprint", "source")


def benchmark_leakage(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: documents, and how many of them equal a benchmark passage."""
    docs = tx.with_fingerprint(read_table(spark, folder, "documents", spread=True), F.col("text"))
    held = tx.with_fingerprint(read_table(spark, folder, "benchmark"), F.col("text"))
    held = held.groupBy("fingerprint").agg(F.min("item_id").alias("item_id"))
    # Copies are counted before the join, so a fingerprint that many documents share stays small.
    copies = docs.groupBy("fingerprint", "source").agg(F.count(F.lit(1)).alias("n"))
    joined = copies.join(held, "fingerprint", "left")
    leaked = F.sum(F.when(F.col("item_id").isNotNull(), F.col("n")))
    return joined.groupBy("source").agg(
        F.sum("n").alias("documents"), F.coalesce(leaked, F.lit(0)).alias("leaked")
    )


def unique_values(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids, normalised texts and normalised sources over all documents."""
    docs = read_table(spark, folder, "documents", spread=True)
    normal = tx.with_fingerprint(docs, F.col("text"), "text_key")
    normal = tx.with_normalized(normal, F.col("source"), "source_key")
    return dist.distinct_values(
        normal,
        {"doc_id": F.col("doc_id"), "text": F.col("text_key"), "source": F.col("source_key")},
    )


def corpus_violations(spark: SparkSession, folder: str) -> DataFrame:
    return rules.violations(d.corpus_lines(spark, folder), d.SYSTEM_TEXT)


FILE_LINES = 150


def corpus_files(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the corpus cut into files, each with line numbers of its own."""
    lines = d.corpus_lines(spark, folder)
    before = F.col("line_no") - 1
    cut = lines.select(
        F.format_string("part-%06d", F.floor(before / FILE_LINES)).alias("source_file"),
        (before % FILE_LINES + 1).alias("line_no"),
        "line",
    )
    return rules.violations(cut, d.SYSTEM_TEXT).drop("detail")


def corpus_first_error(spark: SparkSession, folder: str) -> DataFrame:
    return rules.first_error(corpus_violations(spark, folder))


def corpus_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_counts(corpus_violations(spark, folder))


def corpus_report(spark: SparkSession, folder: str) -> DataFrame:
    """Label totals of the whole corpus."""
    t = d.tickets(spark, folder)
    return dist.label_distribution(t, {name: F.col(name) for name in fv.LABEL_DIMENSIONS})


def semantic_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Nine checks per record, counted."""
    t = d.tickets(spark, folder)
    cue = F.concat(F.lit("P-"), F.col("priority"))
    wrong = F.col("doc_id") % 9 == 0
    user = F.concat_ws(
        " ", F.col("text"), F.when(wrong, F.lit("P-low")), cue, F.concat(F.lit("S-"), F.col("sentiment"))
    )
    response = F.when(F.col("doc_id") % 11 == 0, "Your order has been refunded [ORDER_ID]").otherwise(
        "We will review this"
    )
    action = F.when(F.col("category") == "bug", "triage_report").otherwise("review_ticket")
    rows = t.select(
        user.alias("user"),
        F.struct(
            "category", "priority", "sentiment", response.alias("response"), action.alias("next_action")
        ).alias("expected"),
        (F.col("doc_id") % 13 != 0).alias("consistent"),
        (F.length("text") <= 8000).alias("structured"),
    )
    anchors = {name: ("th", "er", "en") for name in fv.CATEGORIES}
    checks = audits.semantic_checks(
        F.col("user"), F.col("expected"), F.lit(True), F.col("consistent"), F.col("structured"),
        anchors,
        {p: f"P-{p}" for p in fv.PRIORITIES},
        {s: f"S-{s}" for s in fv.SENTIMENTS},
    )
    return audits.check_counts(rows, checks)


def unsafe_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns that claim a completed action or leave identifiers behind."""
    turns = read_table(spark, folder, "conversations", spread=True)
    hits = F.array_join(tx.extended_pii_hits(F.col("text")), ", ")
    return turns.select(
        "conv_id", "turn", tx.unsafe_claim(F.col("text")).alias("unsafe"), hits.alias("identifiers")
    ).where((F.col("identifiers") != "") | F.col("unsafe"))


def prompt_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts made of a document and, for even ids, the full task vocabulary."""
    docs = read_table(spark, folder, "documents", spread=True)
    words = " ".join([*fv.CATEGORIES, *fv.PRIORITIES, *fv.SENTIMENTS, *fv.OUTPUT_FIELDS])
    text = F.concat_ws(" ", F.col("text"), F.when(F.col("doc_id") % 2 == 0, F.lit(words)))
    return audits.prompt_shape(docs, "doc_id", text)


def conversation_shape(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations", spread=True)
    return conversations.conversation_shape(turns, "conv_id", "turn", "role", "text")


def prompt_completion(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations", spread=True)
    return conversations.last_answer_split(turns, "conv_id", "turn", "role").select(
        "conv_id", "turn", "role", "part", F.sha2("text", 256).alias("text_sha256")
    )


def prepared_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical line digest of every prepared record."""
    rows = d.records(spark, folder)
    record = F.struct(*rows.columns)
    projected = rows.select(record.alias("record")).select(
        *conversations.prompt_completion(F.col("record"))
    )
    line = conversations.prepared_json()
    return projected.select(
        "id",
        F.size("prompt").alias("prompt_messages"),
        F.size("completion").alias("completion_messages"),
        F.sha2(line, 256).alias("line_sha256"),
    )


def length_budget(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lengths(spark, folder)
    return dist.length_budget(rows, "full_tokens", "prompt_tokens", 512)


def length_violations(spark: SparkSession, folder: str) -> DataFrame:
    return dist.length_violations(
        _lengths(spark, folder), "conv_id", "full_tokens", "prompt_tokens", 512
    )


def _lengths(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations", spread=True)
    parts = conversations.last_answer_split(turns, "conv_id", "turn", "role")
    words = tx.word_count(F.col("text"))
    return parts.groupBy("conv_id").agg(
        F.sum(words).cast("long").alias("full_tokens"),
        F.coalesce(F.sum(F.when(F.col("part") == "prompt", words)), F.lit(0)).cast("long").alias(
            "prompt_tokens"
        ),
    )


def json_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Strict JSON outcome of event payloads, some of them damaged."""
    events = read_table(spark, folder, "events", spread=True)
    props = F.col("props")
    damaged = (
        F.when(F.col("event_id") % 7 == 1, F.concat(props, F.lit(" tail")))
        .when(F.col("event_id") % 7 == 2, F.concat(F.lit('{"k":1,'), F.substr(props, F.lit(2))))
        .when(F.col("event_id") % 7 == 3, F.concat(F.lit("["), props, F.lit("]")))
        .when(F.col("event_id") % 7 == 4, F.concat(F.lit("  "), props, F.lit("\n")))
        .when(F.col("event_id") % 7 == 5, F.lit('{"k": Infinity}'))
        .otherwise(props)
    )
    read = sj.with_object(events.select("event_id", damaged.alias("payload")), "payload", "json")
    key = F.try_variant_get("json_object", "$.k", "long")
    return read.groupBy(
        "json_strict",
        F.col("json_object").isNotNull().alias("recovered"),
        F.coalesce("json_error", F.lit("")).alias("error"),
    ).agg(F.count(F.lit(1)).alias("payloads"), F.coalesce(F.sum(key), F.lit(0)).alias("key_sum"))


QUERIES = {
    "dup_fingerprint": dup_fingerprint,
    "pii_scan": pii_scan,
    "secret_redaction": secret_redaction,
    "placeholder_counts": placeholder_counts,
    "source_leakage": source_leakage,
    "benchmark_leakage": benchmark_leakage,
    "unique_values": unique_values,
    "corpus_violations": corpus_violations,
    "corpus_files": corpus_files,
    "corpus_first_error": corpus_first_error,
    "corpus_rule_counts": corpus_rule_counts,
    "corpus_report": corpus_report,
    "semantic_audit": semantic_audit,
    "unsafe_claims": unsafe_claims,
    "prompt_shape": prompt_shape,
    "conversation_shape": conversation_shape,
    "prompt_completion": prompt_completion,
    "prepared_lines": prepared_lines,
    "length_budget": length_budget,
    "length_violations": length_violations,
    "json_contract": json_contract,
}

_FP = d.sql_fingerprint("text")
_SECRET = (
    r"regexp_replace(regexp_replace(text, "
    r"'(?i)\b(authorization|token|api[_-]?key|password|secret)(\s*[:=]\s*)(?:bearer\s+)?[^\s,;]+', "
    r"'\1\2[REDACTED]', 'g'), '\bhf_[A-Za-z0-9]{20,}\b', '[REDACTED]', 'g')"
)


def _pii_list(text: str) -> Sql:
    parts = ", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in d.sql_pii(text).items())
    return f"concat_ws(', ', {parts})"


_PREPARED_SQL = (
    "'{\"completion\":[{\"content\":' || j(answer) || ',\"role\":\"assistant\"}],\"expected\":' || answer || "
    "',\"id\":\"' || id || '\",\"pii_placeholders\":[\"[DOC_ID]\"],\"prompt\":[{\"content\":\"' || sys || "
    "'\",\"role\":\"system\"},{\"content\":' || j(text || ' [DOC_ID]') || ',\"role\":\"user\"}],"
    "\"provenance\":{\"contains_real_customer_data\":false,\"created_by\":\"table generator\","
    "\"license\":\"CC0-1.0\",\"source\":\"synthetic\"}}'"
)


def _json_text(sql: str) -> str:
    return sql.replace("j(answer)", "CAST(to_json(answer) AS VARCHAR)").replace(
        "j(text || ' [DOC_ID]')", "CAST(to_json(text || ' [DOC_ID]') AS VARCHAR)"
    )


# The faults of derived.corpus_lines, rule by rule.
_USER = "CASE WHEN fault = 16 THEN text ELSE text || ' [DOC_ID]' END"
SQL_VIOLATIONS = f"""
{d.SQL_TICKETS},
faulted AS (
  SELECT *, doc_id % 40 AS fault, doc_id + 1 AS line_no FROM tickets),
users AS (
  SELECT *, {_USER} AS user_text FROM faulted),
lined AS (
  SELECT *,
    CASE WHEN fault IN (1, 2, 3) THEN ''
         WHEN fault = 5 THEN lower(printf('DOC-%08d', doc_id))
         WHEN fault = 17 THEN '7'
         WHEN fault = 19 THEN printf('DOC-%08d', doc_id - 1)
         ELSE printf('DOC-%08d', doc_id) END AS id,
    fault NOT IN (1, 2, 3) AND length({d.sql_strip('user_text')}) NOT BETWEEN 1 AND 8000 AS long_text
  FROM users),
field_rules AS (
  SELECT line_no, id, unnest([x FOR x IN [
    CASE WHEN fault = 1 THEN 'blank_line' END,
    CASE WHEN fault IN (2, 3) THEN 'strict_json' END,
    CASE WHEN fault = 4 THEN 'unknown_keys' END,
    CASE WHEN fault = 17 THEN 'field_types' END,
    CASE WHEN fault IN (5, 17) THEN 'id_pattern' END,
    CASE WHEN fault = 6 THEN 'message_count' END,
    CASE WHEN long_text THEN 'message_length' END,
    CASE WHEN fault = 8 THEN 'category_label' END,
    CASE WHEN fault = 9 THEN 'response_length' END,
    CASE WHEN fault = 10 THEN 'next_action_pattern' END,
    CASE WHEN fault = 11 THEN 'provenance' END
  ] IF x IS NOT NULL]) AS rule,
  CASE WHEN fault = 3 THEN 'duplicate JSON object key: ''id''' ELSE '' END AS detail
  FROM lined),
fields_ok AS (
  SELECT * FROM lined WHERE line_no NOT IN (SELECT line_no FROM field_rules)),
record_rules AS (
  SELECT line_no, id, unnest([x FOR x IN [
    CASE WHEN fault = 7 THEN 'role_order' END,
    CASE WHEN fault = 13 THEN 'system_message' END,
    CASE WHEN fault = 15 THEN 'assistant_json' END,
    CASE WHEN fault = 14 THEN 'assistant_matches_expected' END,
    CASE WHEN fault IN (12, 16) THEN 'placeholder_inventory' END,
    CASE WHEN fault = 16 THEN 'user_placeholder' END
  ] IF x IS NOT NULL]) AS rule, '' AS detail
  FROM fields_ok),
good AS (
  SELECT line_no, id, user_text, {d.sql_fingerprint('user_text')} AS fp FROM fields_ok
  WHERE line_no NOT IN (SELECT line_no FROM record_rules)),
pii_rules AS (
  SELECT line_no, id, 'unredacted_pii' AS rule, {_pii_list('user_text')} AS detail FROM good),
same_id AS (
  SELECT line_no, id, min(line_no) OVER (PARTITION BY id) AS first_line FROM good),
same_text AS (
  SELECT line_no, id, min(line_no) OVER (PARTITION BY fp) AS first_line,
         first_value(id) OVER (PARTITION BY fp ORDER BY line_no) AS first_id FROM good),
found AS (
  SELECT line_no, id, rule, 0 AS phase, detail FROM field_rules
  UNION ALL SELECT line_no, id, rule, 0, detail FROM record_rules
  UNION ALL SELECT line_no, id, rule, 1, detail FROM pii_rules WHERE detail <> ''
  UNION ALL SELECT line_no, id, 'duplicate_id', 1, 'first seen on line ' || first_line
    FROM same_id WHERE line_no > first_line
  UNION ALL SELECT line_no, id, 'duplicate_content', 1,
    'matches ' || first_id || ' on line ' || first_line FROM same_text WHERE line_no > first_line),
ordered AS (
  SELECT line_no, id, rule,
    list_position([{', '.join(f"'{r}'" for r in rules.RULES)}], rule) - 1 AS rule_order, phase, detail
  FROM found)"""

_SHAPE_TEXT = d.sql_strip("text")
ORACLES: dict[str, Sql] = {
    "dup_fingerprint": f"""
WITH f AS (SELECT doc_id, {_FP} AS fingerprint FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY fingerprint) AS first_doc_id,
             count(*) OVER (PARTITION BY fingerprint) AS copies FROM f)
SELECT doc_id, fingerprint, first_doc_id, copies FROM g WHERE doc_id > first_doc_id""",
    "pii_scan": f"""
SELECT * FROM (SELECT doc_id, {_pii_list('text')} AS hits FROM documents) WHERE hits <> ''""",
    "secret_redaction": f"""
WITH r AS (SELECT doc_id, text, {_SECRET} AS clean FROM documents)
SELECT doc_id, sha256(clean) AS redacted_sha256, length(clean) AS redacted_chars
FROM r WHERE clean <> text""",
    "placeholder_counts": rf"""
WITH r AS (SELECT unnest(regexp_extract_all({_SECRET}, '\[[A-Z][A-Z0-9_]*\]')) AS placeholder FROM documents)
SELECT placeholder, count(*) AS occurrences FROM r GROUP BY 1""",
    "source_leakage": f"""
SELECT {_FP} AS fingerprint, count(DISTINCT source) AS sets, count(*) AS rows,
       min(source) AS first_set, max(source) AS last_set
FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1""",
    "benchmark_leakage": f"""
SELECT source, count(*) AS documents,
       count(*) FILTER ({_FP} IN (SELECT {_FP} FROM benchmark)) AS leaked
FROM documents GROUP BY source""",
    "unique_values": f"""
SELECT 'doc_id' AS "column", count(*) AS rows, count(DISTINCT doc_id) AS "distinct" FROM documents
UNION ALL SELECT 'text', count(*), count(DISTINCT {_FP}) FROM documents
UNION ALL SELECT 'source', count(*), count(DISTINCT lower(source)) FROM documents""",
    "corpus_violations": f"WITH {SQL_VIOLATIONS} SELECT * FROM ordered",
    "corpus_files": f"""WITH {SQL_VIOLATIONS}
SELECT printf('part-%06d', (line_no - 1) // {FILE_LINES}) AS source_file,
  (line_no - 1) % {FILE_LINES} + 1 AS line_no, id, rule, rule_order, phase
FROM ordered""",
    "corpus_first_error": f"""WITH {SQL_VIOLATIONS}
SELECT line_no, id, rule, detail FROM ordered ORDER BY phase, line_no, rule_order LIMIT 1""",
    "corpus_rule_counts": f"""WITH {SQL_VIOLATIONS}
SELECT rule, count(*) AS violations, min(line_no) AS first_line FROM ordered GROUP BY rule""",
    "corpus_report": f"""WITH {d.SQL_TICKETS}
SELECT 'category' AS dimension, category AS label, count(*) AS rows FROM tickets GROUP BY 2
UNION ALL SELECT 'priority', priority, count(*) FROM tickets GROUP BY 2
UNION ALL SELECT 'sentiment', sentiment, count(*) FROM tickets GROUP BY 2""",
    "semantic_audit": rf"""WITH {d.SQL_TICKETS},
r AS (SELECT *, concat_ws(' ', text, CASE WHEN doc_id % 9 = 0 THEN 'P-low' END,
      'P-' || priority, 'S-' || sentiment) AS u FROM tickets),
k AS (SELECT
  length(text) <= 8000 AS c1,
  contains(lower(u), 'th') OR contains(lower(u), 'er') OR contains(lower(u), 'en') AS c2,
  doc_id % 9 <> 0 OR priority = 'low' AS c3,
  true AS c4, true AS c5,
  doc_id % 11 <> 0 AS c6,
  NOT {d.sql_any_pii('u')}
  AND NOT regexp_matches(u, '(^|[^0-9.])([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}([^0-9.]|$)')
  AND NOT regexp_matches(u, '(?i)(https?://|www\.)\S+')
  AND NOT regexp_matches(u, '(?i)(^|[^0-9a-f])[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}([^0-9a-f]|$)')
  AND NOT regexp_matches(u, '(^|[^0-9])[0-9]{{9,}}')
  AND NOT regexp_matches(u, '(?i)(password|passcode|secret|token|api[_-]?key)\s*[:=]\s*[^\s,;]+') AS c7,
  doc_id % 13 <> 0 AS c8, true AS c9 FROM r)
SELECT 'record_structure' AS "check", count(*) FILTER (c1) AS passed, count(*) FILTER (NOT c1) AS failed FROM k
UNION ALL SELECT 'category_support', count(*) FILTER (c2), count(*) FILTER (NOT c2) FROM k
UNION ALL SELECT 'priority_support', count(*) FILTER (c3), count(*) FILTER (NOT c3) FROM k
UNION ALL SELECT 'sentiment_support', count(*) FILTER (c4), count(*) FILTER (NOT c4) FROM k
UNION ALL SELECT 'next_action_policy', count(*) FILTER (c5), count(*) FILTER (NOT c5) FROM k
UNION ALL SELECT 'response_safe_no_completed_resolution', count(*) FILTER (c6), count(*) FILTER (NOT c6) FROM k
UNION ALL SELECT 'pii_absence_and_placeholder_safety', count(*) FILTER (c7), count(*) FILTER (NOT c7) FROM k
UNION ALL SELECT 'assistant_expected_consistency', count(*) FILTER (c8), count(*) FILTER (NOT c8) FROM k
UNION ALL SELECT 'synthetic_provenance', count(*) FILTER (c9), count(*) FILTER (NOT c9) FROM k""",
    "unsafe_claims": rf"""
WITH r AS (SELECT conv_id, turn,
  regexp_matches(text, '(?i)\b(has|have) been (refunded|cancelled|canceled|deleted|unlocked|shipped|resolved)\b')
  OR regexp_matches(text, '(?i)\bi(''ve| have) (already )?(fixed|refunded|cancelled|reset|unlocked|resolved)\b')
  OR regexp_matches(text, '(?i)\bguarantee[ds]?\b')
  OR regexp_matches(text, '(?i)\bsend (me|us) your (password|card|code)\b') AS unsafe,
  concat_ws(', ', nullif({_pii_list('text')}, ''),
    CASE WHEN regexp_matches(text, '(^|[^0-9.])([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}([^0-9.]|$)') THEN 'ipv4 address' END,
    CASE WHEN regexp_matches(text, '(?i)(https?://|www\.)\S+') THEN 'url' END,
    CASE WHEN regexp_matches(text, '(?i)(^|[^0-9a-f])[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}([^0-9a-f]|$)') THEN 'uuid' END,
    CASE WHEN regexp_matches(text, '(^|[^0-9])[0-9]{{9,}}') THEN 'long number' END,
    CASE WHEN regexp_matches(text, '(?i)(password|passcode|secret|token|api[_-]?key)\s*[:=]\s*[^\s,;]+') THEN 'credential value' END
  ) AS identifiers FROM conversations)
SELECT * FROM r WHERE unsafe OR identifiers <> ''""",
    "prompt_shape": """
SELECT doc_id, doc_id % 2 = 0 AS has_labels, doc_id % 2 = 0 AS has_fields FROM documents""",
    "conversation_shape": f"""
WITH t AS (SELECT *, length({_SHAPE_TEXT}) AS n FROM conversations),
c AS (SELECT conv_id, count(*) AS turns, list(turn ORDER BY turn) AS ts, list(role ORDER BY turn) AS roles,
        count(*) FILTER (role = 'system') AS system_turns,
        count(*) FILTER (role = 'system' AND turn > 0) AS late_system_turns,
        count(*) FILTER (n NOT BETWEEN 1 AND 8000) AS bad_lengths
      FROM t GROUP BY conv_id),
p AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k
      FROM conversations WHERE role <> 'system'),
parity AS (SELECT conv_id,
        count(DISTINCT CASE WHEN role = 'user' THEN turn % 2 END) <= 1
        AND count(DISTINCT CASE WHEN role = 'assistant' THEN turn % 2 END) <= 1
        AND coalesce(min(CASE WHEN role = 'user' THEN turn % 2 END)
                     <> min(CASE WHEN role = 'assistant' THEN turn % 2 END), true) AS alternating
      FROM p GROUP BY conv_id)
SELECT c.conv_id, turns, ts[1] = 0 AND ts[-1] = turns - 1 AS contiguous, system_turns, late_system_turns,
       coalesce(alternating, true) AS alternating, roles[-1] = 'assistant' AS ends_with_assistant, bad_lengths
FROM c LEFT JOIN parity USING (conv_id)""",
    "prompt_completion": """
WITH a AS (SELECT conv_id, max(turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT c.conv_id, turn, role, CASE WHEN turn = answer THEN 'completion' ELSE 'prompt' END AS part,
       sha256(text) AS text_sha256
FROM conversations c JOIN a ON c.conv_id = a.conv_id AND turn <= answer""",
    "prepared_lines": rf"""WITH {d.SQL_TICKETS},
r AS (SELECT printf('DOC-%08d', doc_id) AS id, text, '{d.SYSTEM_TEXT}' AS sys,
  '{{"category":"' || category || '","next_action":"review_ticket","priority":"' || priority
  || '","response":"We look into record ' || doc_id || ' and reply.","sentiment":"' || sentiment || '"}}' AS answer
  FROM tickets)
SELECT id, 2 AS prompt_messages, 1 AS completion_messages,
  sha256({_json_text(_PREPARED_SQL)}) AS line_sha256 FROM r""",
    "length_budget": r"""
WITH a AS (SELECT conv_id, max(turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
w AS (SELECT c.conv_id, turn = answer AS done, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS n
      FROM conversations c JOIN a ON c.conv_id = a.conv_id AND turn <= answer),
l AS (SELECT conv_id, sum(n) AS f, coalesce(sum(n) FILTER (NOT done), 0) AS p FROM w GROUP BY conv_id)
SELECT count(*) AS examples, CAST(max(f) AS BIGINT) AS max_full_tokens,
       CAST(min(f - p) AS BIGINT) AS min_completion_tokens,
       count(*) FILTER (f > 512) AS over_limit, count(*) FILTER (f - p <= 0) AS without_completion FROM l""",
    "length_violations": r"""
WITH a AS (SELECT conv_id, max(turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
w AS (SELECT c.conv_id, turn = answer AS done, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS n
      FROM conversations c JOIN a ON c.conv_id = a.conv_id AND turn <= answer),
l AS (SELECT conv_id, CAST(sum(n) AS BIGINT) AS full_tokens,
      CAST(coalesce(sum(n) FILTER (NOT done), 0) AS BIGINT) AS prompt_tokens FROM w GROUP BY conv_id)
SELECT *, CASE WHEN full_tokens > 512 THEN 'over limit' ELSE 'no completion' END AS problem
FROM l WHERE full_tokens > 512 OR full_tokens <= prompt_tokens""",
    "json_contract": """
WITH e AS (SELECT event_id % 7 AS m, CAST(props->>'$.k' AS BIGINT) AS k FROM events)
SELECT m IN (0, 4, 6) AS json_strict, m NOT IN (2, 5) AS recovered,
  CASE WHEN m = 2 THEN 'duplicate JSON object key: ''k'''
       WHEN m = 5 THEN 'non-finite JSON constant is not permitted: Infinity' ELSE '' END AS error,
  count(*) AS payloads, CAST(sum(CASE WHEN m IN (2, 5) THEN 0 ELSE k END) AS BIGINT) AS key_sum
FROM e GROUP BY 1, 2, 3""",
}
