"""Registered evaluation queries: scores, summaries, gates, comparison, parity, recomputation."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.catalog import derived as d
from assaykit.functions import strict_json as sj
from assaykit.functions import text as tx
from assaykit.operators import audits, comparing, parity, rules, scoring
from assaykit.plans import evaluation
from assaykit.session import durable
from assaykit.tables import read_table

FLAGS = [
    "parse_error", "strict_json_only", "schema_valid", "field_completeness", "category_correct",
    "priority_correct", "sentiment_correct", "response_policy_compliant", "exact_match",
    "predicted_category", "predicted_priority", "predicted_sentiment", "latency_ms",
]
BASE_SALT = 7


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _scores(spark: SparkSession, folder: str, salt: int = 0) -> DataFrame:
    return scoring.score_predictions(d.predictions(spark, folder, salt), ["position"])


def score_rows(spark: SparkSession, folder: str) -> DataFrame:
    labels = {f"predicted_{n}": F.coalesce(f"predicted_{n}", F.lit("")) for n in fv.LABEL_DIMENSIONS}
    return (
        _scores(spark, folder)
        .withColumn("parse_error", F.coalesce("parse_error", F.lit("")))
        .withColumns(labels)
        .select("id", *FLAGS)
    )


def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    # Only the narrow score columns are read twice (rates, then percentiles).
    narrow = durable(_scores(spark, folder).drop("prediction", "parsed"))
    out = scoring.summarize(narrow)
    return _rounded(out, [c for c in out.columns if c != "examples"])


def score_gates(spark: SparkSession, folder: str) -> DataFrame:
    summary = scoring.summarize(_scores(spark, folder), latency=False)
    return _rounded(scoring.gate_decisions(summary), ["value"])


def label_confusion(spark: SparkSession, folder: str) -> DataFrame:
    flat = _scores(spark, folder).select("expected.category", "predicted_category")
    return scoring.label_confusion(flat, "category", "predicted_category", fv.CATEGORIES)


def macro_f1_open(spark: SparkSession, folder: str) -> DataFrame:
    flat = _scores(spark, folder).select("expected.category", "predicted_category")
    return _rounded(scoring.macro_f1_open(flat, "category", "predicted_category"), ["macro_f1"])


def macro_f1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rule-based quality guesses against document labels, per language."""
    docs = read_table(spark, folder, "documents")
    guess = F.when(F.length("text") < 400, 0).when(F.col("doc_id") % 17 != 0, 1)
    rows = docs.join(read_table(spark, folder, "labels"), "doc_id").select(
        "lang", F.col("quality").cast("string").alias("quality"), guess.cast("string").alias("guess")
    )
    return _rounded(scoring.macro_f1_open(rows, "quality", "guess", ["lang"]), ["macro_f1"])


def compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    out = comparing.compare_runs(_scores(spark, folder), _scores(spark, folder, BASE_SALT))
    return _rounded(out, ["candidate", "baseline", "delta"])


def cohort_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Guards found between a run and a copy with lost, moved, changed and repeated rows."""
    t = d.tickets(spark, folder).select(
        d.record_id(F.col("doc_id")).alias("id"), F.col("doc_id").alias("position"), "category"
    )
    n = F.col("position")
    other = (
        t.where(n % 50 != 0)
        .withColumn("category", F.when(n % 90 == 1, "changed").otherwise(F.col("category")))
        .withColumn("position", F.when(n % 70 == 1, n + 1).otherwise(n))
    )
    other = other.unionByName(t.where(n % 110 == 1))
    extra = t.where(n % 130 == 1).withColumn("id", F.concat(F.lit("NEW-"), "id"))
    return comparing.cohort_problems(
        t.unionByName(extra), other, expected=["category"]
    ).groupBy("problem").agg(F.count(F.lit(1)).alias("cases"), F.min("id").alias("first_id"))


def _parity_pairs(spark: SparkSession, folder: str) -> DataFrame:
    adapter = d.predictions(spark, folder)
    other = d.predictions(spark, folder, 3)
    moved = F.col("position") % 6 == 0
    merged = adapter.where(~moved).unionByName(other.where(moved))
    return parity.pair_predictions(adapter, merged)


def parity_metrics(spark: SparkSession, folder: str) -> DataFrame:
    out = parity.parity_metrics(_parity_pairs(spark, folder))
    return _rounded(out, [c for c in out.columns if c != "examples"])


def parity_gates(spark: SparkSession, folder: str) -> DataFrame:
    metrics = parity.parity_metrics(_parity_pairs(spark, folder))
    return _rounded(parity.parity_decisions(metrics), ["value"])


def parity_guards(spark: SparkSession, folder: str) -> DataFrame:
    """Why two prediction sets may not be compared: unusable rows, lost ids, absent lineage."""
    adapter = d.predictions(spark, folder).select("id", "position", "expected").withColumns(
        {"model_revision": F.lit("r1"), "problem": F.lit(None).cast("string")}
    )
    n = F.col("position")
    merged = adapter.withColumns(
        {
            "problem": F.when(n % 31 == 0, "not an object"),
            "id": F.when(n % 41 == 0, "").otherwise(F.col("id")),
            "model_revision": F.when(n % 37 == 0, F.lit(None)).when(n % 43 == 0, "r2").otherwise("r1"),
            "dataset_split_sha256": F.sha2(F.lit("test"), 256),
        }
    )
    found = evaluation.parity_problems(adapter, merged)
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("cases"), F.min("id").alias("first_id"))


def heldout_binding(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions that are not bound to the held-out rows they should answer."""
    rows = d.predictions(spark, folder).select("id", "position", "expected")
    manifest, split = (F.sha2(F.lit(name), 256) for name in ("manifest", "test"))
    n = F.col("position")
    changed = F.col("expected").withField("category", F.lit("changed"))
    made = rows.where(n % 53 != 0).withColumns(
        {
            "position": F.when(n % 47 == 0, n + 1).otherwise(n),
            "expected": F.when(n % 59 == 0, changed).otherwise(F.col("expected")),
            "dataset_manifest_sha256": F.when(n % 61 == 0, split).when(n % 67 != 0, manifest),
            "dataset_split_sha256": F.when(n % 71 != 0, split),
            "training_dataset_sha256": F.when(
                n % 5 == 0, F.create_map(F.lit("test"), F.when(n % 73 == 0, manifest).otherwise(split))
            ),
        }
    )
    made = made.unionByName(made.where(n % 79 == 0).withColumn("id", F.concat(F.lit("NEW-"), "id")))
    made = made.unionByName(made.where(n % 83 == 0))
    known = {name: hashlib.sha256(name.encode()).hexdigest() for name in ("manifest", "test")}
    found = comparing.heldout_problems(made, rows, known["manifest"], known["test"])
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("cases"), F.min("id").alias("first_id"))


def parity_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return parity.mismatches(_parity_pairs(spark, folder))


def recompute_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Published scores with some altered values against freshly computed ones."""
    scores = durable(
        _scores(spark, folder).select("id", "position", *[f for f in FLAGS if f != "latency_ms"])
    )
    n = F.col("position")
    published = (
        scores.where(n % 61 != 0)
        .withColumn("exact_match", F.when(n % 53 == 0, ~F.col("exact_match")).otherwise(F.col("exact_match")))
        .withColumn("predicted_category", F.when(n % 47 == 0, "changed").otherwise(F.col("predicted_category")))
    )
    fields = [f for f in FLAGS if f != "latency_ms"]
    return audits.table_differences(published, scores, "id", fields)


def summary_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Published summary metrics that differ from the recomputed ones."""
    summary = scoring.summarize(_scores(spark, folder), latency=False)
    values = scoring.metric_rows(summary, fv.NON_REGRESSION_METRICS)
    off = F.when(F.col("metric") == "category_accuracy", 0.25).when(
        F.col("metric") == "exact_match_rate", 1e-13
    ).otherwise(0.0)
    published = values.withColumn("value", F.col("value") + off)
    return _rounded(audits.summary_differences(published, values), ["published", "recomputed"])


def threshold_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Problems of a published gate table: one gate lost, one renamed, one value and flag altered."""
    summary = scoring.summarize(_scores(spark, folder), latency=False)
    values = durable(scoring.metric_rows(summary, list(fv.ABSOLUTE_MINIMUMS)))
    gates = scoring.gate_decisions(summary)
    published = (
        gates.where("metric <> 'response_policy_rate'")
        .withColumn("metric", F.when(F.col("metric") == "schema_valid_rate", "schema_rate").otherwise(F.col("metric")))
        .withColumn("value", F.when(F.col("metric") == "category_accuracy", 2.0).otherwise(F.col("value")))
        .withColumn("minimum", F.when(F.col("metric") == "priority_accuracy", 0.5).otherwise(F.col("minimum")))
        .withColumn("passed", F.when(F.col("metric") == "strict_json_rate", ~F.col("passed")).otherwise(
            F.col("value") >= F.col("minimum")))
    )
    return audits.threshold_problems(published, values, fv.ABSOLUTE_MINIMUMS)


def prediction_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction rows with values they may not have."""
    docs = read_table(spark, folder, "documents")
    n = F.col("doc_id")
    rows = docs.select(
        F.when(n % 41 == 0, "").otherwise(d.record_id(n)).alias("id"),
        F.when(n % 43 == 0, F.lit(float("nan"))).when(n % 43 == 1, -1.0).when(
            n % 43 == 2, F.lit(float("inf"))).otherwise(F.col("n_chars") / 4.0).alias("latency_ms"),
        F.when(n % 37 == 0, -1).otherwise(F.col("n_chars")).cast("int").alias("prompt_tokens"),
        F.when(n % 31 == 0, F.concat(F.lit("x"), F.sha2("text", 256))).otherwise(
            F.sha2("text", 256)).alias("dataset_split_sha256"),
    )
    return rules.prediction_row_problems(rows).groupBy("problem").agg(
        F.count(F.lit(1)).alias("cases"), F.max("id").alias("last_id")
    )


def _generated(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """Rows of the generated prediction schema; lineage faults follow from the document id."""
    docs = read_table(spark, folder, "documents")
    n = F.col("doc_id")

    def digest(name: str):
        return F.sha2(F.lit(name), 256)

    none = F.lit(None).cast("string")
    no_map = F.create_map().cast("map<string,string>")
    no_list = F.array().cast("array<string>")
    adapter = role == "adapter"
    dataset = F.create_map(
        *[x for key in fv.LINEAGE_DATASET_KEYS for x in (
            F.lit(key), F.when((n % 29 == 0) & (F.lit(key) == "test"), digest("other")).otherwise(digest(key)))],
        F.lit("qualification_report"), digest("report"),
    )
    return docs.select(
        d.record_id(n).alias("id"),
        n.alias("position"),
        F.when(n % 23 != 0, digest("manifest")).alias("dataset_manifest_sha256"),
        digest("test").alias("dataset_split_sha256"),
        digest("generation").alias("generation_config_sha256"),
        F.when(n % 19 != 0, digest("training")).alias("training_manifest_sha256"),
        digest("config").alias("training_config_sha256"),
        dataset.alias("training_dataset_sha256"),
        F.create_map(F.lit("qualification_report"),
                     F.when(n % 17 == 0, digest("x")).otherwise(digest("report"))).alias("qualification_sha256"),
        F.lit("models/base").alias("model_name_or_path"),
        F.when(n >= 100, "r2").otherwise("r1").alias("model_revision"),
        (F.when(n % 13 != 0, "adapters/one") if adapter else F.when(n % 13 == 0, "adapters/one")).alias("adapter_path"),
        (digest("adapter") if adapter else none).alias("adapter_config_sha256"),
        (F.create_map(F.lit("w.bin"), digest("w")) if adapter else no_map).alias("adapter_weight_sha256"),
        (F.when(n % 11 == 0, "merged/one") if adapter else F.lit("merged/one")).alias("merged_model_path"),
        (none if adapter else digest("merge")).alias("merge_provenance_sha256"),
        (no_map if adapter else F.create_map(F.lit("m.bin"), digest("m"))).alias("merged_artifact_sha256"),
        (none if adapter else digest("adapter")).alias("merged_adapter_config_sha256"),
        (no_list if adapter else F.when(n % 7 == 0, F.array(F.lit("w.bin"), F.lit("w.bin"))).otherwise(
            F.array(F.lit("w.bin")))).alias("merged_adapter_weight_files"),
        (no_list if adapter else F.array(digest("w"))).alias("merged_adapter_weight_sha256"),
    )


def lineage_problems(spark: SparkSession, folder: str) -> DataFrame:
    found = None
    for role in ("adapter", "merged"):
        one = parity.lineage_problems(_generated(spark, folder, role), role).withColumn("role", F.lit(role))
        found = one if found is None else found.unionByName(one)
    return found.groupBy("role", "problem").agg(F.count(F.lit(1)).alias("rows"))


def provenance_values(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage fields that are not one value over all rows, with the first row that differs."""
    rows = _generated(spark, folder, "adapter")
    fields = ["dataset_manifest_sha256", "dataset_split_sha256", "model_revision", "adapter_path",
              "training_dataset_sha256"]
    return parity.single_value_problems(rows.select("position", *[
        F.col(f) if "dataset_sha" not in f else F.array_sort(F.map_entries(f)).alias(f) for f in fields
    ]), fields, "position")


def provenance_presence(spark: SparkSession, folder: str) -> DataFrame:
    return parity.mixed_presence(_generated(spark, folder, "adapter"), "dataset_manifest_sha256")


def weight_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose adapter weights equal the merged side's lists."""
    left = _generated(spark, folder, "adapter").select("id", F.col("adapter_weight_sha256").alias("weights"))
    right = _generated(spark, folder, "merged").select(
        "id", "merged_adapter_weight_files", "merged_adapter_weight_sha256"
    )
    same = parity.same_weights(
        F.col("weights"), F.col("merged_adapter_weight_files"), F.col("merged_adapter_weight_sha256")
    )
    return left.join(right, "id").groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("rows"))


def chat_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Chat completion bodies around the predictions, model lists and header maps."""
    rows = d.predictions(spark, folder)
    n = F.col("position")
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("prediction").alias("content")).alias("message"))).alias("choices")))
    models = F.to_json(F.struct(F.array(
        F.struct(F.lit("base").alias("id"), F.lit(None).cast("string").alias("parent")),
        F.struct(F.when(n % 5 == 0, "other").otherwise("tuned").alias("id"),
                 F.when(n % 3 == 0, "strange").otherwise("base").alias("parent")),
    ).alias("data")))
    headers = F.create_map(F.when(n % 2 == 0, "X-Request-ID").otherwise("x-request-id"),
                           F.when(n % 7 == 0, "  ").otherwise("abc"))
    claims = sj.model_claims(models, F.lit("tuned"), F.lit("base"))
    return (
        rows.select(
            sj.chat_schema_valid(F.when(n % 10 == 0, F.concat(body, F.lit(" x"))).otherwise(body)).alias("schema_valid"),
            claims["listed"].alias("listed"),
            claims["parent_matches"].alias("parent_matches"),
            tx.header_present(headers, "X-Request-Id").alias("request_id"),
        )
        .groupBy("schema_valid", "listed", "parent_matches", "request_id")
        .agg(F.count(F.lit(1)).alias("responses"))
    )


QUERIES = {
    "score_rows": score_rows,
    "score_summary": score_summary,
    "score_gates": score_gates,
    "label_confusion": label_confusion,
    "macro_f1_open": macro_f1_open,
    "macro_f1_quality": macro_f1_quality,
    "compare_runs": compare_runs,
    "cohort_problems": cohort_problems,
    "parity_metrics": parity_metrics,
    "parity_gates": parity_gates,
    "parity_guards": parity_guards,
    "heldout_binding": heldout_binding,
    "parity_mismatches": parity_mismatches,
    "recompute_audit": recompute_audit,
    "summary_audit": summary_audit,
    "threshold_audit": threshold_audit,
    "prediction_problems": prediction_problems,
    "lineage_problems": lineage_problems,
    "provenance_values": provenance_values,
    "provenance_presence": provenance_presence,
    "weight_lineage": weight_lineage,
    "chat_responses": chat_responses,
}

_BASE = f"{d.SQL_TICKETS}, {d.sql_predictions('cand')}"


def _f1(name: str, table: str) -> str:
    return f"""(SELECT avg(CASE WHEN a + g > 0 THEN 2.0 * h / (a + g) ELSE 0 END) FROM (
      SELECT (SELECT count(*) FROM {table} WHERE {name} = l) AS a,
             (SELECT count(*) FROM {table} WHERE predicted_{name} = l) AS g,
             (SELECT count(*) FROM {table} WHERE {name} = l AND predicted_{name} = l) AS h
      FROM (SELECT unnest({d.SQL_LABELS[name]}) AS l)))"""


def _metrics(table: str) -> dict[str, str]:
    return {
        "strict_json_rate": f"(SELECT avg(strict_json_only::INT) FROM {table})",
        "schema_valid_rate": f"(SELECT avg(schema_valid::INT) FROM {table})",
        "field_completeness_rate": f"(SELECT avg(field_completeness) FROM {table})",
        "category_accuracy": f"(SELECT avg(category_correct::INT) FROM {table})",
        "priority_accuracy": f"(SELECT avg(priority_correct::INT) FROM {table})",
        "sentiment_accuracy": f"(SELECT avg(sentiment_correct::INT) FROM {table})",
        "response_policy_rate": f"(SELECT avg(response_policy_compliant::INT) FROM {table})",
        "exact_match_rate": f"(SELECT avg(exact_match::INT) FROM {table})",
        **{f"{n}_macro_f1": _f1(n, table) for n in fv.LABEL_DIMENSIONS},
    }


_M = _metrics("cand")
_B = _metrics("base_run")


def _gates() -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {_M[m]} AS value, {v}::DOUBLE AS minimum" for m, v in fv.ABSOLUTE_MINIMUMS.items()
    )


_PAIRS = f"""{_BASE}, {d.sql_predictions('moved', 3)},
merged AS (SELECT * FROM cand WHERE doc_id % 6 <> 0 UNION ALL SELECT * FROM moved WHERE doc_id % 6 = 0),
pairs AS (SELECT a.id, a.position, a.schema_valid AS av, m.schema_valid AS mv,
  a.schema_valid AND m.schema_valid AS ok, a.doc_id % 6 <> 0 AS raw_match,
  a.strict_json_only AND m.strict_json_only AS objects,
  a.strict_json_only AND m.strict_json_only AND a.doc_id % 6 <> 0 AS object_match,
  a.schema_valid AND m.schema_valid AND a.predicted_category = m.predicted_category AS c,
  a.schema_valid AND m.schema_valid AND a.predicted_priority = m.predicted_priority AS p,
  a.schema_valid AND m.schema_valid AND a.predicted_sentiment = m.predicted_sentiment AS s
  FROM cand a JOIN merged m USING (id))"""
_PARITY = {
    "adapter_schema_valid_rate": "av", "merged_schema_valid_rate": "mv", "category_match_rate": "c",
    "priority_match_rate": "p", "sentiment_match_rate": "s", "next_action_match_rate": "ok",
    "routing_match_rate": "(c AND p AND s)", "response_exact_rate": "ok",
    "raw_prediction_exact_rate": "raw_match", "parsed_object_exact_rate": "object_match",
}
_KINDS = {
    "adapter_schema_invalid": "NOT av", "merged_schema_invalid": "NOT mv", "contract_invalid": "NOT ok",
    "raw_prediction": "NOT raw_match", "parsed_object": "objects AND NOT object_match",
    "routing": "ok AND NOT (c AND p AND s)", "release_blocked": "NOT ok OR NOT (c AND p AND s)",
    "category": "ok AND NOT c", "priority": "ok AND NOT p", "sentiment": "ok AND NOT s",
}
_AUDIT_FIELDS = [f for f in FLAGS if f != "latency_ms"]

ORACLES = {
    "score_rows": f"""WITH {_BASE} SELECT id, parse_error, strict_json_only, schema_valid, field_completeness,
  category_correct, priority_correct, sentiment_correct, response_policy_compliant, exact_match,
  coalesce(predicted_category, '') AS predicted_category, coalesce(predicted_priority, '') AS predicted_priority,
  coalesce(predicted_sentiment, '') AS predicted_sentiment, latency_ms FROM cand""",
    "score_summary": f"""WITH {_BASE} SELECT count(*) AS examples,
  {', '.join(f'round({sql}, 9) AS {m}' for m, sql in _M.items())},
  round(avg(latency_ms), 9) AS latency_mean_ms, round(quantile_cont(latency_ms, 0.5), 9) AS latency_p50_ms,
  round(quantile_cont(latency_ms, 0.95), 9) AS latency_p95_ms FROM cand""",
    "score_gates": f"""WITH {_BASE}, g AS ({_gates()})
SELECT metric, round(value, 9) AS value, minimum, value >= minimum AS passed FROM g""",
    "label_confusion": f"""WITH {_BASE} SELECT l AS label,
  count(*) FILTER (category = l AND coalesce(predicted_category, '__invalid__') = l) AS true_positive,
  count(*) FILTER (category <> l AND coalesce(predicted_category, '__invalid__') = l) AS false_positive,
  count(*) FILTER (category = l AND coalesce(predicted_category, '__invalid__') <> l) AS false_negative
FROM cand, (SELECT unnest({d.SQL_LABELS['category']}) AS l) GROUP BY 1""",
    "macro_f1_open": f"""WITH {_BASE}, g AS (SELECT category AS e, coalesce(predicted_category, '__invalid__') AS p FROM cand),
l AS (SELECT e AS label FROM g UNION SELECT p FROM g),
f AS (SELECT label, 2.0 * count(*) FILTER (e = label AND p = label)
  / (count(*) FILTER (e = label) + count(*) FILTER (p = label)) AS f1 FROM g, l GROUP BY 1)
SELECT round(avg(f1), 9) AS macro_f1, count(*) AS labels FROM f""",
    "macro_f1_quality": """
WITH g AS (SELECT lang, CAST(quality AS VARCHAR) AS e,
  CASE WHEN length(text) < 400 THEN '0' WHEN doc_id % 17 <> 0 THEN '1' ELSE '__invalid__' END AS p
  FROM documents JOIN labels USING (doc_id)),
l AS (SELECT lang, e AS label FROM g UNION SELECT lang, p FROM g),
f AS (SELECT l.lang, label, 2.0 * count(*) FILTER (e = label AND p = label)
  / (count(*) FILTER (e = label) + count(*) FILTER (p = label)) AS f1 FROM g JOIN l USING (lang) GROUP BY 1, 2)
SELECT lang, round(avg(f1), 9) AS macro_f1, count(*) AS labels FROM f GROUP BY 1""",
    "compare_runs": f"""WITH {_BASE}, {d.sql_predictions('base_run', BASE_SALT)},
m AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, {_M[m]} AS c, {_B[m]} AS b" for m in fv.NON_REGRESSION_METRICS)})
SELECT metric, round(c, 9) AS candidate, round(b, 9) AS baseline, round(c - b, 9) AS delta, c - b >= 0 AS passed FROM m""",
    "cohort_problems": f"""WITH {d.SQL_TICKETS},
t AS (SELECT printf('DOC-%08d', doc_id) AS id, doc_id AS n, category FROM tickets),
a AS (SELECT id, n AS position, category FROM t UNION ALL SELECT 'NEW-' || id, n, category FROM t WHERE n % 130 = 1),
b AS (SELECT id, CASE WHEN n % 70 = 1 THEN n + 1 ELSE n END AS position,
        CASE WHEN n % 90 = 1 THEN 'changed' ELSE category END AS category FROM t WHERE n % 50 <> 0
      UNION ALL SELECT id, n, category FROM t WHERE n % 110 = 1),
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position, category) AS k FROM b) WHERE k = 1),
j AS (SELECT coalesce(a.id, b1.id) AS id, a.position AS ap, b1.position AS bp, a.category AS ac, b1.category AS bc
      FROM a FULL JOIN b1 ON a.id = b1.id),
f AS (SELECT id, 'missing from candidate' AS problem FROM j WHERE ap IS NULL
  UNION ALL SELECT id, 'missing from baseline' FROM j WHERE bp IS NULL
  UNION ALL SELECT id, 'position differs' FROM j WHERE ap <> bp
  UNION ALL SELECT id, 'expected output differs' FROM j WHERE ac <> bc
  UNION ALL SELECT id, 'repeated in candidate' FROM a GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT id, 'repeated in baseline' FROM b GROUP BY id HAVING count(*) > 1)
SELECT problem, count(*) AS cases, min(id) AS first_id FROM f GROUP BY 1""",
    "parity_metrics": f"""WITH {_PAIRS} SELECT count(*) AS examples,
  {', '.join(f'round(avg({flag}::INT), 9) AS {m}' for m, flag in _PARITY.items())} FROM pairs""",
    "parity_gates": f"""WITH {_PAIRS}, g AS ({' UNION ALL '.join(
        f"SELECT '{m}' AS metric, avg({_PARITY[m]}::INT) AS value FROM pairs" for m in fv.PARITY_GATES)})
SELECT metric, round(value, 9) AS value, 1.0::DOUBLE AS required, value = 1.0 AS passed FROM g""",
    "parity_guards": """
WITH a AS (SELECT doc_id AS n, printf('DOC-%08d', doc_id) AS id FROM documents),
m AS (SELECT n, CASE WHEN n % 41 = 0 THEN '' ELSE id END AS id, n % 31 = 0 AS broken,
  CASE WHEN n % 37 = 0 THEN NULL WHEN n % 43 = 0 THEN 'r2' ELSE 'r1' END AS revision FROM a),
whole AS (SELECT * FROM m WHERE NOT broken),
seen AS (SELECT id, min(n) AS n, count(*) AS copies FROM whole GROUP BY id),
first AS (SELECT seen.id, whole.revision, copies, seen.n FROM seen JOIN whole ON seen.id = whole.id AND seen.n = whole.n),
f AS (SELECT 'merged: not an object' AS problem, id FROM m WHERE broken
  UNION ALL SELECT 'merged: id empty', id FROM m WHERE id = '' AND NOT broken
  UNION ALL SELECT 'merged: id repeated', id FROM m GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT 'merged: model_revision absent', NULL WHERE EXISTS (SELECT 1 FROM m WHERE revision IS NULL)
  UNION ALL SELECT 'adapter: dataset_split_sha256 absent', NULL WHERE EXISTS (SELECT 1 FROM a)
  UNION ALL SELECT 'missing from candidate', id FROM a WHERE id NOT IN (SELECT id FROM first)
  UNION ALL SELECT 'missing from baseline', id FROM first WHERE id = ''
  UNION ALL SELECT 'repeated in candidate', id FROM first WHERE copies > 1
  UNION ALL SELECT 'model_revision differs', id FROM first WHERE id <> '' AND revision IS DISTINCT FROM 'r1'
  UNION ALL SELECT 'dataset_split_sha256 differs', id FROM first WHERE id <> '')
SELECT problem, count(*) AS cases, min(id) AS first_id FROM f GROUP BY 1""",
    "heldout_binding": """
WITH h AS (SELECT doc_id AS n, printf('DOC-%08d', doc_id) AS id FROM documents),
p0 AS (SELECT n, id, n % 47 = 0 AS moved, n % 59 = 0 AS changed, n % 61 = 0 OR n % 67 = 0 AS other_manifest,
  n % 71 = 0 AS other_split, n % 5 = 0 AND n % 73 = 0 AS other_training FROM h WHERE n % 53 <> 0),
p1 AS (SELECT * FROM p0 UNION ALL SELECT * REPLACE ('NEW-' || id AS id) FROM p0 WHERE CASE WHEN moved THEN n + 1 ELSE n END % 79 = 0),
-- rows are moved before they are copied, so the places decide
p AS (SELECT *, CASE WHEN moved THEN n + 1 ELSE n END AS place FROM p1),
p2 AS (SELECT * FROM p UNION ALL SELECT * FROM p WHERE place % 83 = 0),
one AS (SELECT id, any_value(moved) AS moved, any_value(changed) AS changed, count(*) AS copies FROM p2 GROUP BY id),
f AS (SELECT 'missing from predictions' AS problem, id FROM h WHERE id NOT IN (SELECT id FROM one)
  UNION ALL SELECT 'missing from held-out rows', id FROM one WHERE id LIKE 'NEW-%'
  UNION ALL SELECT 'position differs', id FROM one WHERE moved AND id NOT LIKE 'NEW-%'
  UNION ALL SELECT 'expected output differs', id FROM one WHERE changed AND id NOT LIKE 'NEW-%'
  UNION ALL SELECT 'repeated in predictions', id FROM one WHERE copies > 1
  UNION ALL SELECT 'manifest digest differs', id FROM p2 WHERE other_manifest
  UNION ALL SELECT 'split digest differs', id FROM p2 WHERE other_split
  UNION ALL SELECT 'training test digest differs', id FROM p2 WHERE other_training)
SELECT problem, count(*) AS cases, min(id) AS first_id FROM f GROUP BY 1""",
    "parity_mismatches": f"""WITH {_PAIRS}
{' UNION ALL '.join(f"SELECT '{k}' AS kind, id, position FROM pairs WHERE {c}" for k, c in _KINDS.items())}""",
    "recompute_audit": f"""WITH {_BASE}
SELECT id, 'not published' AS field FROM cand WHERE doc_id % 61 = 0
UNION ALL SELECT id, 'exact_match' FROM cand WHERE doc_id % 61 <> 0 AND doc_id % 53 = 0
UNION ALL SELECT id, 'predicted_category' FROM cand WHERE doc_id % 61 <> 0 AND doc_id % 47 = 0""",
    "summary_audit": f"""WITH {_BASE}
SELECT 'category_accuracy' AS metric, round({_M['category_accuracy']} + 0.25, 9) AS published,
  round({_M['category_accuracy']}, 9) AS recomputed""",
    "threshold_audit": f"""WITH {_BASE}, g AS ({_gates()})
SELECT 'response_policy_rate' AS metric, 'missing' AS problem
UNION ALL SELECT 'schema_valid_rate', 'missing' UNION ALL SELECT 'schema_rate', 'unexpected'
UNION ALL SELECT 'category_accuracy', 'value differs from summary' FROM g WHERE metric = 'category_accuracy' AND value <> 2
UNION ALL SELECT 'priority_accuracy', 'minimum differs from configuration'
UNION ALL SELECT 'strict_json_rate', 'pass flag inconsistent'""",
    "prediction_problems": """
WITH t AS (SELECT doc_id AS n, CASE WHEN doc_id % 41 = 0 THEN '' ELSE printf('DOC-%08d', doc_id) END AS id FROM documents),
f AS (SELECT id, 'id empty' AS problem FROM t WHERE n % 41 = 0
  UNION ALL SELECT id, 'latency not a finite non-negative number' FROM t WHERE n % 43 IN (0, 1, 2)
  UNION ALL SELECT id, 'prompt_tokens negative' FROM t WHERE n % 37 = 0
  UNION ALL SELECT id, 'dataset_split_sha256 malformed' FROM t WHERE n % 31 = 0)
SELECT problem, count(*) AS cases, max(id) AS last_id FROM f GROUP BY 1""",
    "lineage_problems": """
WITH r AS (SELECT unnest(['adapter', 'merged']) AS role, doc_id AS n FROM documents),
f AS (SELECT role, 'dataset manifest digest missing' AS problem FROM r WHERE n % 23 = 0
  UNION ALL SELECT role, 'training lineage incomplete' FROM r WHERE n % 19 = 0
  UNION ALL SELECT role, 'training manifest digest differs from dataset' FROM r WHERE n % 23 = 0
  UNION ALL SELECT role, 'training test digest differs from split' FROM r WHERE n % 29 = 0
  UNION ALL SELECT role, 'qualification digests differ from training lineage' FROM r WHERE n % 17 = 0
  UNION ALL SELECT role, 'adapter identity incomplete' FROM r WHERE role = 'adapter' AND n % 13 = 0
  UNION ALL SELECT role, 'adapter rows declare a merged model' FROM r WHERE role = 'adapter' AND n % 11 = 0
  UNION ALL SELECT role, 'merged rows declare an adapter' FROM r WHERE role = 'merged' AND n % 13 = 0
  UNION ALL SELECT role, 'merged weight lineage invalid' FROM r WHERE role = 'merged' AND n % 7 = 0)
SELECT role, problem, count(*) AS rows FROM f GROUP BY 1, 2""",
    "provenance_values": """
WITH t AS (SELECT doc_id AS n, min(doc_id) OVER () AS lo FROM documents)
SELECT 'dataset_manifest_sha256' AS field, min(n) AS first_position FROM t WHERE (n % 23 = 0) <> (lo % 23 = 0)
UNION ALL SELECT 'model_revision', min(n) FROM t WHERE (n >= 100) <> (lo >= 100)
UNION ALL SELECT 'adapter_path', min(n) FROM t WHERE (n % 13 = 0) <> (lo % 13 = 0)
UNION ALL SELECT 'training_dataset_sha256', min(n) FROM t WHERE (n % 29 = 0) <> (lo % 29 = 0)""",
    "provenance_presence": """
SELECT count(*) AS rows, count(*) FILTER (doc_id % 23 <> 0) AS present,
  count(*) FILTER (doc_id % 23 <> 0) IN (0, count(*)) AS consistent FROM documents""",
    "weight_lineage": "SELECT doc_id % 7 <> 0 AS same, count(*) AS rows FROM documents GROUP BY 1",
    "chat_responses": f"""WITH {_BASE}
SELECT schema_valid AND doc_id % 10 <> 0 AS schema_valid, doc_id % 5 <> 0 AS listed,
  doc_id % 5 <> 0 AND doc_id % 3 <> 0 AS parent_matches, doc_id % 7 <> 0 AS request_id, count(*) AS responses
FROM cand GROUP BY 1, 2, 3, 4""",
}
