"""Operators on small frames, including skewed ones."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions.digests import canonical_json, tree_digest
from assaykit.operators import comparing, conversations, distributions, duplicates, percentiles
from assaykit.operators import parity, ranking, reviews, rules, scoring, serving
from assaykit.plans import evaluation
from assaykit.schemas import PREDICTION


def answer(category, priority, sentiment, response="We will check this for you.", action="review_case"):
    return {"category": category, "priority": priority, "sentiment": sentiment, "response": response, "next_action": action}


def as_json(values):
    return "{" + ",".join(f'"{k}":"{v}"' for k, v in values.items()) + "}"


@pytest.fixture(scope="module")
def golden(spark):
    one, two, three = answer("billing", "low", "angry"), answer("bug", "high", "neutral"), answer("shipping", "urgent", "worried")
    rows = [
        ("a", one, as_json(one), 10.0),
        ("b", two, "Here you go:\n```json\n" + as_json(two) + "\n```", 20.0),
        ("c", three, "I cannot say.", 30.0),
    ]
    return spark.createDataFrame(rows, PREDICTION)


def test_golden_summary(golden):
    done = evaluation.evaluate(golden)
    s = done.summary.first().asDict()
    want = {
        "examples": 3, "strict_json_rate": 1 / 3, "schema_valid_rate": 1 / 3, "category_accuracy": 2 / 3,
        "category_macro_f1": 2 / 7, "priority_macro_f1": 0.5, "sentiment_accuracy": 2 / 3, "sentiment_macro_f1": 0.4,
        "response_policy_rate": 2 / 3, "latency_mean_ms": 20.0, "latency_p50_ms": 20.0, "latency_p95_ms": 29.0,
    }
    for name, value in want.items():
        assert s[name] == pytest.approx(value, abs=1e-12), name
    errors = {r["id"]: r["parse_error"] for r in done.scores.collect()}
    assert errors == {"a": None, "b": "output is not one bare JSON object", "c": "no JSON object found"}
    assert not any(r["passed"] for r in done.decisions.collect() if r["metric"] == "strict_json_rate")


def test_recovered_labels_count_but_not_the_contract(spark):
    want = answer("bug", "low", "angry")
    rows = [
        ("lower", want, as_json(want | {"category": " bug"}), None),
        ("trim", want, as_json(want | {"response": "  We will check this for you. "}), None),
        ("number", want, as_json(want).replace('"low"', "3"), None),
        ("pii", want, as_json(want | {"response": "Write to me@site.org please"}), None),
        ("extra", want, as_json(want)[:-1] + ',"x":1,"y":2}', None),
        ("empty", want, "{}", None),
    ]
    got = {r["id"]: r for r in scoring.score_predictions(spark.createDataFrame(rows, PREDICTION)).collect()}
    assert not got["lower"]["schema_valid"] and not got["lower"]["category_correct"]
    assert got["trim"]["exact_match"] and got["trim"]["schema_valid"]
    assert got["number"]["predicted_priority"] is None and got["number"]["field_completeness"] == 1.0
    assert got["pii"]["schema_valid"] and not got["pii"]["response_policy_compliant"]
    assert got["extra"]["parse_error"] == "schema validation failed: 2 error(s)"
    assert got["empty"]["parse_error"] == "schema validation failed: 5 error(s)"


def test_empty_input_gives_zero_rates(spark):
    s = scoring.summarize(scoring.score_predictions(spark.createDataFrame([], PREDICTION))).first()
    assert s["examples"] == 0 and s["exact_match_rate"] == 0.0 and s["latency_p50_ms"] is None


def brute_percentile(values, q, method):
    values = sorted(values)
    if method == "nearest":
        return values[max(1, math.ceil(q * len(values))) - 1]
    spot = (len(values) - 1) * q
    low, high = values[math.floor(spot)], values[math.ceil(spot)]
    return low + (high - low) * (spot - math.floor(spot))


@pytest.mark.parametrize("slice_rows", [10**6, 40, 1])
@pytest.mark.parametrize("method", ["linear", "nearest"])
def test_percentiles_are_exact_on_large_skewed_groups(spark, method, slice_rows):
    rng = random.Random(1)
    data = {
        "hot": [5.0 if rng.random() < 0.4 else rng.lognormvariate(0, 3) for _ in range(40_000)],
        "ties": [float(rng.randrange(3)) for _ in range(15_000)],
        "one": [7.25],
        "few": [rng.random() for _ in range(11)],
        "signs": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(5_000)] + [0.0, -0.0],
    }
    frame = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    quantiles = {"p00": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.999, "p100": 1.0}
    for row in percentiles.exact_percentiles(frame, ["g"], "v", quantiles, method, slice_rows).collect():
        for name, q in quantiles.items():
            assert row[name] == pytest.approx(brute_percentile(data[row["g"]], q, method), rel=1e-12), (row["g"], name)


@pytest.mark.parametrize("parts", [1, 7])
def test_duplicates_with_a_hot_key(spark, parts):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 1500}") for i in range(6000)]
    frame = spark.createDataFrame(rows, "n long, k string").repartition(parts)
    got = {r["n"]: (r["first"]["n"], r["copies"]) for r in duplicates.repeated_rows(frame, "k", ["n"]).collect()}
    first, copies = {}, {}
    for n, k in rows:
        first.setdefault(k, n)
        copies[k] = copies.get(k, 0) + 1
    assert got == {n: (first[k], copies[k]) for n, k in rows if n != first[k]}


def test_duplicates_beyond_the_broadcast_heavy_groups(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "HEAVY_GROUPS", 3)
    rows = [(i, f"k{i % 50}") for i in range(500)]
    frame = spark.createDataFrame(rows, "n long, k string")
    assert duplicates.repeated_rows(frame, "k", ["n"]).count() == 450


@pytest.mark.parametrize("prefix", [1, 2, 4])
def test_rank_by_digest_is_a_global_rank(spark, prefix):
    frame = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = ranking.rank_by_digest(frame, ["g"], "k", prefix_hex=prefix).collect()
    for g in range(3):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["k"])
        assert [r["position"] for r in mine] == list(range(1000))


def test_tree_digest_depends_on_content_and_order_only(spark):
    frame = spark.range(500).select("id", F.concat(F.lit("line "), "id").alias("l"))
    one = tree_digest(frame.repartition(1), [], "id", F.col("l"), fan_out=8, levels=4).first()
    seven = tree_digest(frame.repartition(7), [], "id", F.col("l"), fan_out=8, levels=4).first()
    swapped = frame.withColumn("id", F.when(F.col("id") == 3, 4).when(F.col("id") == 4, 3).otherwise(F.col("id")))
    other = tree_digest(swapped, [], "id", F.col("l"), fan_out=8, levels=4).first()
    assert one == seven and one["lines"] == 500 and other["digest"] != one["digest"]


def test_canonical_json_writes_control_characters_in_lower_case(spark):
    texts = ["".join(map(chr, range(32))), "\\u000B", "\x0b\x0b\\\x1f", "\\\\u001F\x1f", "a\x7f/é\"\u2028", "\\", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["j"] for r in frame.select(canonical_json({"t": F.col("t")}).alias("j")).collect()]
    assert got == [json.dumps({"t": t}, ensure_ascii=False, separators=(",", ":")) for t in texts]


def test_canonical_json_sorts_and_keeps_nulls(spark):
    row = spark.range(1).select(canonical_json({"b": F.lit("é/x"), "a": F.lit(None).cast("string")}).alias("j")).first()
    assert row["j"] == '{"a":null,"b":"é/x"}'


def test_cohort_problems_and_deltas(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")], "id string, position long, e string")
    assert comparing.cohort_problems(left, left, expected=["e"]).count() == 0
    moved = spark.createDataFrame([("b", 1, "x"), ("a", 2, "y"), ("d", 3, "x")], "id string, position long, e string")
    got = {(r["problem"], r["id"]) for r in comparing.cohort_problems(left, moved, expected=["e"]).collect()}
    assert got == {("position differs", "a"), ("position differs", "b"), ("expected output differs", "a"),
                   ("missing from baseline", "c"), ("missing from candidate", "d")}


def test_provenance_guard(spark):
    ddl = "dataset_manifest_sha256 string, adapter_path string"
    cand = spark.createDataFrame([("m", "a")], ddl)
    fine = spark.createDataFrame([("m", None)], ddl)
    bad = spark.createDataFrame([("n", "b")], ddl)
    args = (["dataset_manifest_sha256"], ["adapter_path"])
    assert comparing.provenance_problems(cand, fine, *args).count() == 0
    assert {r["problem"] for r in comparing.provenance_problems(cand, bad, *args).collect()} == {
        "dataset_manifest_sha256 differs", "baseline declares adapter_path"}


def test_identical_invalid_predictions_do_not_pass_parity(spark):
    rows = spark.createDataFrame([("a", 0, "not json"), ("b", 1, as_json(answer("bug", "low", "angry")))], "id string, position long, prediction string")
    done = evaluation.parity(rows, rows)
    m = done.metrics.first()
    assert m["raw_prediction_exact_rate"] == 1.0 and m["routing_match_rate"] == 0.5
    assert not done.decisions.agg(F.bool_and("passed")).first()[0]
    kinds = {(r["kind"], r["id"]) for r in done.mismatches.collect()}
    assert kinds == {(k, "a") for k in ("adapter_schema_invalid", "merged_schema_invalid", "contract_invalid", "release_blocked")}


def base_review(spark):
    ids = [(i, f"R{i}") for i in range(1200)]
    source = spark.createDataFrame(ids, "position long, id string")
    prepared = spark.createDataFrame(
        [("train", i, x) for i, x in ids[200:]] + [("test", i, x) for i, x in ids[:200]], "split string, position long, id string")
    freeze = spark.createDataFrame(ids[:200], "position long, id string")
    decisions = spark.createDataFrame(
        [(p, i, x, *["approved"] * 4) for p in ("p1", "p2") for i, x in ids],
        "path string, position long, record_id string, labels string, response string, pii string, license string")
    packets = spark.createDataFrame(
        [("p1", "Ada L", "approved", "S", "P", "F", "d1", "d1"), ("p2", "Bo M", "approved", "S", "P", "F", "d2", "d2")],
        "path string, reviewer_id string, status string, source_sha256 string, prepared_manifest_sha256 string, "
        "holdout_freeze_sha256 string, declared_sha256 string, sha256 string").withColumn("review_date", F.lit("2026-01-01").cast("date"))
    header = spark.createDataFrame(
        [("1.2", "S", "S", 1200, 1200, "P", "P", "S", "F", "F", "S", "P", "approved")],
        "schema_version string, source_sha256 string, observed_source_sha256 string, record_count long, total_examples long, "
        "prepared_sha256 string, observed_prepared_sha256 string, prepared_source_sha256 string, freeze_sha256 string, "
        "observed_freeze_sha256 string, freeze_source_sha256 string, freeze_prepared_sha256 string, approval_status string",
    ).withColumn("review_date", F.lit("2026-01-02").cast("date"))
    return {"header": header, "source": source, "prepared": prepared, "freeze": freeze, "packets": packets, "decisions": decisions}


MUTATIONS = {
    "none": ({}, set()),
    "stale source": ({"header": lambda d: d.withColumn("source_sha256", F.lit("X"))}, {"source_sha256_matches"}),
    "undated": ({"header": lambda d: d.withColumn("review_date", F.lit(None).cast("date"))}, {"approved_status"}),
    "swapped freeze": ({"freeze": lambda d: d.withColumn("position", F.pmod(F.col("position") + 1, F.lit(200)))},
                       {"holdout_freeze_matches_prepared_test"}),
    "one rejection": ({"decisions": lambda d: d.withColumn("pii", F.when(F.col("record_id") == "R7", "rejected").otherwise(F.col("pii")))},
                      {"review_packet_decisions_approved", "full_record_review"}),
    "same reviewer": ({"packets": lambda d: d.withColumn("reviewer_id", F.lit("Ada L"))}, {"reviewer_ids_distinct"}),
    "scaffold name": ({"packets": lambda d: d.withColumn("reviewer_id", F.concat(F.lit("todo "), "path"))}, {"reviewer_ids_non_placeholder"}),
    "packet order": ({"decisions": lambda d: d.withColumn("position", F.when(F.col("path") == "p2", 1199 - F.col("position")).otherwise(F.col("position")))},
                     {"review_packets_cover_ordered_source"}),
    "lost prepared row": ({"prepared": lambda d: d.where("id <> 'R900'")}, {"prepared_manifest_record_ids_match"}),
}


@pytest.mark.parametrize("name", list(MUTATIONS))
def test_one_mutation_fails_its_policies(spark, name):
    tables = base_review(spark)
    changes, failing = MUTATIONS[name]
    for table, change in changes.items():
        tables[table] = change(tables[table])
    rows = reviews.qualify(**tables).collect()
    assert tuple(r["policy"] for r in rows) == fv.CURRENT_POLICIES
    assert {r["policy"] for r in rows if not r["passed"]} == failing


def test_load_summary_of_four_outcomes(spark):
    rows = [(200, 10.0, True, True, None), (200, 20.0, True, True, None), (200, 30.0, True, True, None), (503, 40.0, False, False, "http_error")]
    frame = spark.createDataFrame(rows, "status int, latency_ms double, schema_valid boolean, request_id boolean, error_code string")
    s = serving.load_summary(frame).first()
    assert (s["success_rate"], s["schema_valid_rate"], s["request_id_rate"]) == (0.75, 0.75, 0.75)
    assert (s["latency_p50_ms"], s["latency_p95_ms"], s["passed"]) == (20.0, 40.0, False)
    with pytest.raises(ValueError):
        serving.load_summary(frame, min_success_rate=1.5)


def test_conversation_shape(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 1, "user", " ")]
    frame = spark.createDataFrame(rows, "c long, t long, r string, x string")
    got = {r["c"]: r for r in conversations.conversation_shape(frame, "c", "t", "r", "x").collect()}
    assert got[1]["alternating"] and got[1]["ends_with_assistant"] and got[1]["contiguous"]
    assert not got[2]["alternating"] and got[2]["bad_lengths"] == 1


def test_macro_f1_without_labels_counts_missing_guesses(spark):
    frame = spark.createDataFrame([("a", "a"), ("a", None), ("b", "b")], "e string, g string")
    row = scoring.macro_f1_open(frame, "e", "g").first()
    assert row["labels"] == 3 and row["macro_f1"] == pytest.approx((2 / 3 + 1 + 0) / 3)


def test_coverage_is_only_asked_where_it_can_be_met(spark):
    rows = [("validation", "low"), ("validation", "high"), ("test", "low"), ("test", "low"), ("train", "high"), ("train", "high")]
    frame = spark.createDataFrame(rows, "split string, priority string")
    got = {r["split"]: r for r in distributions.holdout_coverage(frame, "split", {"priority": ["low", "high"]}).collect()}
    assert got["validation"]["passed"] and not got["test"]["passed"] and got["test"]["missing_labels"] == 1
    none = distributions.holdout_coverage(frame, "split", {"priority": ["low", "high", "urgent"]}).collect()
    assert all(r["passed"] and not r["feasible"] for r in none)


def test_rules_on_blank_and_empty(spark):
    lines = spark.createDataFrame([(1, "\u00a0 "), (2, "[]"), (3, "{}")], "line_no long, line string")
    got = [(r["line_no"], r["rule"]) for r in rules.violations(lines, "s").orderBy("line_no", "rule_order").collect()]
    assert got[:2] == [(1, "blank_line"), (2, "strict_json")] and ("field_types" in {r for n, r in got if n == 3})
    assert rules.empty_dataset(lines.where("line_no > 9")).first()["empty"]


def test_single_value_and_weights(spark):
    rows = spark.createDataFrame([(0, "a", {"w": "1"}), (1, "a", {"w": "1"}), (2, "b", {"w": "1"}), (3, "c", {"w": "1"})], "position long, m string, w map<string,string>")
    got = parity.single_value_problems(rows.select("position", "m"), ["m"], "position").collect()
    assert [(r["field"], r["first_position"]) for r in got] == [("m", 2)]
    same = rows.select(parity.same_weights(F.col("w"), F.array(F.lit("w")), F.array(F.lit("1"))).alias("ok")).distinct().collect()
    assert [r["ok"] for r in same] == [True]
