"""Readers, writers, whole jobs and streams."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit import schemas
from assaykit.functions.digests import tree_digest
from assaykit.operators import audits, comparing, distributions, rules
from assaykit.plans import corpus, evaluation
from assaykit.sources import documents, grid, inventory, jsonl, sinks
from assaykit.streaming import closing, feed

TEXTS = grid.GridTexts()


def test_line_numbers_across_splits_and_files(spark, tmp_path):
    rng = random.Random(2)
    want = {}
    for name in ("a.jsonl", "b.jsonl"):
        lines = ["" if rng.random() < 0.2 else f"{name} {i} " + "x" * rng.randint(1, 60) for i in range(3000)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want[name] = lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        read = jsonl.read_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 3
        got = [(os.path.basename(r["source_file"]), r["line_no"], r["line"]) for r in read.collect()]
        used = [
            (os.path.basename(r["source_file"]), r["line_no"], r["position"])
            for r in jsonl.read_lines(spark, str(tmp_path), skip_blank=True).collect()
        ]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted((n, i, x) for n, lines in want.items() for i, x in enumerate(lines, 1))
    expected = [
        (n, i, p)
        for n, lines in want.items()
        for p, (i, _) in enumerate(((i, x) for i, x in enumerate(lines, 1) if x), 1)
    ]
    assert sorted(used) == sorted(expected)


def test_prediction_reader_reports_bad_rows(spark, tmp_path):
    good = {"id": "A", "expected": {"category": "bug"}, "prediction": "x", "latency_ms": 1.5}
    rows = [json.dumps(good), "", json.dumps({"expected": {}, "prediction": "y"}), json.dumps({"prediction": "z"}),
            json.dumps({"expected": {}}), "[1]", '{"expected":{},"expected":{},"prediction":""}']
    (tmp_path / "p.jsonl").write_text("\n".join(rows))
    got = jsonl.read_predictions(spark, str(tmp_path / "p.jsonl")).orderBy("line_no").collect()
    assert [(r["line_no"], r["problem"]) for r in got] == [
        (1, None), (3, None), (4, "missing expected output"), (5, "missing prediction text"),
        (6, "not one JSON object"), (7, "duplicate JSON object key: 'expected'")]
    assert [r["id"] for r in got[:2]] == ["A", "example-00002"] and got[0]["expected"]["category"] == "bug"


def scenarios(spark):
    rows = [
        (c, v, f"Issue {c.replace('_', ' ')} number {chr(96 + v)} for [CASE_ID].", "the case", "review_case", ["[CASE_ID]"])
        for c in fv.CATEGORIES for v in range(1, 9)
    ]
    return spark.createDataFrame(rows, "category string, variant int, issue string, subject string, next_action string, placeholders array<string>")


@pytest.fixture(scope="module")
def grid_lines(spark):
    made = grid.label_grid(scenarios(spark), TEXTS)
    ordered = made.withColumn("line_no", F.row_number().over(__import__("pyspark").sql.Window.orderBy("id")))
    return ordered.select("line_no", F.to_json(F.struct(*made.columns)).alias("line"))


def test_grid_is_valid_and_balanced(spark, grid_lines):
    assert rules.violations(grid_lines, TEXTS.system).count() == 0
    made = grid.label_grid(scenarios(spark), TEXTS).select("id", "expected.*", F.substring("id", -2, 2).alias("variant"))
    balance = {r["level"]: r for r in distributions.balance_summary(
        distributions.grid_balance(made, ["category", "priority", "sentiment"], "variant")).collect()}
    assert balance["cell"]["labels"] == 140 and balance["cell"]["min_rows"] == balance["cell"]["max_rows"] == 8
    assert balance["category"]["min_rows"] == 160 and balance["sentiment"]["max_rows"] == 224


def test_prepare_and_verify(spark, grid_lines, tmp_path):
    checked = corpus.validate(grid_lines, TEXTS.system)
    assert checked.first_error.count() == 0
    made = corpus.prepare(checked.clean, prefix_hex=1)
    records = made.records.cache()
    sizes = {r["split"]: r["n"] for r in records.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"train": 840, "validation": 140, "test": 140}
    assert made.leakage.count() == 0
    assert all(r["passed"] for r in made.coverage.collect())
    sinks.write_split_lines(records.select("split", "position", "line"), str(tmp_path / "out"))
    back = None
    for split in fv.SPLITS:
        one = jsonl.read_prepared(spark, str(tmp_path / "out" / f"split={split}")).withColumn("split", F.lit(split))
        back = one if back is None else back.unionByName(one)
    expected = records.select("split", "position", "id", "line", *[f"expected.{n}" for n in fv.LABEL_DIMENSIONS])
    digests = tree_digest(expected, ["split"], "position", F.col("line"))
    assert corpus.verify(expected, back, digests, made.manifest_labels).count() == 0
    broken = back.withColumn("line", F.when((F.col("position") == 3) & (F.col("split") == "test"), "{}").otherwise(F.col("line")))
    got = [tuple(r) for r in corpus.verify(expected, broken, digests, made.manifest_labels).collect()]
    assert got == [("bytes differ", "test", 1)]
    records.unpersist()
    assert corpus.manifest_settings_match(42, fv.DEFAULT_FRACTIONS, 42, dict(fv.DEFAULT_FRACTIONS))
    assert not corpus.manifest_settings_match(42, fv.DEFAULT_FRACTIONS, 43, dict(fv.DEFAULT_FRACTIONS))


def test_validation_reports_the_first_error_by_phase(spark, grid_lines):
    rows = [r["line"] for r in grid_lines.orderBy("line_no").limit(6).collect()]
    rows[1] = rows[0]
    rows[4] = rows[4].replace('"system"', '"robot"', 1)
    lines = spark.createDataFrame(list(enumerate(rows, 1)), "line_no long, line string")
    done = corpus.validate(lines, TEXTS.system)
    assert done.first_error.first()["rule"] == "message_role" and done.first_error.first()["line_no"] == 5
    found = {(r["line_no"], r["rule"]) for r in done.violations.collect()}
    assert (2, "duplicate_id") in found and (2, "duplicate_content") in found
    assert done.clean.count() == 4


def test_semantic_audit_of_the_grid(spark):
    made = grid.label_grid(scenarios(spark), TEXTS)
    anchors = {c: (c.split("_")[0],) for c in fv.CATEGORIES}
    checks = audits.semantic_checks(
        F.get("messages", F.lit(1))["content"], F.col("expected"), F.lit(True), F.lit(True), F.lit(True),
        anchors, TEXTS.priority_cues, TEXTS.sentiment_cues)
    counts = {r["check"]: (r["passed"], r["failed"]) for r in audits.check_counts(made, checks).collect()}
    assert counts["priority_support"] == counts["sentiment_support"] == counts["category_support"] == (1120, 0)
    assert counts["response_safe_no_completed_resolution"] == (1120, 0)
    assert counts["next_action_policy"][1] > 0  # 'review_case' is no bug or security... prefix everywhere


def test_write_once(spark, tmp_path):
    one = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 3.0)], "id int, latency_ms double")
    path = str(tmp_path / "t")
    assert sinks.write_once(one, path) and not sinks.write_once(one.orderBy(F.desc("id")), path)
    with pytest.raises(FileExistsError):
        sinks.write_once(one.distinct(), path)
    assert not sinks.publish_predictions(one.withColumn("latency_ms", F.lit(9.0)), path)
    with pytest.raises(FileExistsError):
        sinks.publish_predictions(one.withColumn("id", F.col("id") + 1), path)


def test_documents_and_inventory(spark, tmp_path):
    packet = {"schema_version": "1.0", "reviewer_id": "Ada", "status": "approved", "review_date": "2026-01-01",
              "decisions": [{"record_id": "R1", "labels": "approved"}, {"record_id": "R2", "labels": "pending"}]}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "p.json").write_text(json.dumps(packet, indent=2))
    (tmp_path / "m.json").write_text(json.dumps({"split_ids": {"test": ["x", "y"]}, "splits": {"test": {"count": 2}}}))
    read = documents.read_document(spark, str(tmp_path / "sub" / "p.json"), schemas.REVIEWER_PACKET)
    assert [(r["position"], r["record_id"], r["labels"]) for r in documents.packet_decisions(read).collect()] == [
        (0, "R1", "approved"), (1, "R2", "pending")]
    manifest = documents.read_document(spark, str(tmp_path / "m.json"), schemas.DATASET_MANIFEST)
    assert [tuple(r) for r in documents.manifest_ids(manifest).collect()] == [("test", 0, "x"), ("test", 1, "y")]
    listed = inventory.file_inventory(spark, str(tmp_path))
    assert {r["path"] for r in listed.collect()} == {"sub/p.json", "m.json"}
    status = inventory.inventory_diff(listed, listed.where("path <> 'm.json'")).collect()
    assert {(r["path"], r["status"]) for r in status} == {("m.json", "missing"), ("sub/p.json", "same")}
    versions = spark.createDataFrame([('{"schema_version":"1.1"}',), ('{"schema_version":"1.2"}',), ("{}",)], "t string")
    assert [r["reader"] for r in documents.review_version(versions, "t").collect()] == ["legacy", "current", "unsupported"]


def test_feed_drops_repeated_content(spark, tmp_path):
    spark.createDataFrame([("Hello  World", 1), ("hello, world!", 2), ("other", 3)], "t string, s long").select(
        "t", F.timestamp_seconds("s").alias("ts")).write.parquet(str(tmp_path / "in"))
    records = spark.readStream.schema("t string, ts timestamp").parquet(str(tmp_path / "in"))
    seen = closing.run_to_table(feed.first_in_feed(records, F.col("t"), "ts", "1 day"), spark)
    assert seen.count() == 2


def written(folder, files):
    for name, lines in files.items():
        (folder / name).write_bytes(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines))
    return str(folder)


def places(rows):
    return sorted((os.path.basename(r["source_file"]), r["line_no"], r["rule"]) for r in rows.collect())


def test_validation_over_several_files(spark, grid_lines, tmp_path):
    rows = [r["line"] for r in grid_lines.orderBy("line_no").limit(5).collect()]
    folder = written(tmp_path, {"a.jsonl": [rows[0], "{", rows[1]], "b.jsonl": rows[2:5]})
    done = corpus.validate(jsonl.read_lines(spark, folder), TEXTS.system)
    assert places(done.violations) == [("a.jsonl", 2, "strict_json")]
    assert done.clean.count() == 5
    assert os.path.basename(done.first_error.first()["source_file"]) == "a.jsonl"


def test_copies_in_two_files_are_found(spark, grid_lines, tmp_path):
    row = grid_lines.orderBy("line_no").first()["line"]
    folder = written(tmp_path, {"a.jsonl": [row], "b.jsonl": [row]})
    done = corpus.validate(jsonl.read_lines(spark, folder), TEXTS.system)
    assert places(done.violations) == [
        ("b.jsonl", 1, "duplicate_content"), ("b.jsonl", 1, "duplicate_id"),
    ]
    assert done.clean.count() == 1
    details = [r["detail"] for r in done.violations.collect()]
    assert all("on line 1 of" in x and x.endswith("a.jsonl") for x in details)


def test_bad_bytes_and_empty_sets_are_violations(spark, grid_lines, tmp_path):
    row = grid_lines.orderBy("line_no").first()["line"].encode()
    folder = written(tmp_path, {"a.jsonl": [row.replace(b"system", b"syst\xffm", 1), row]})
    done = corpus.validate(jsonl.read_lines(spark, folder), TEXTS.system)
    assert places(done.violations) == [("a.jsonl", 1, "not_utf8")] and done.clean.count() == 1
    nothing = spark.createDataFrame([], "line_no long, line string")
    done = corpus.validate(nothing, TEXTS.system)
    assert done.first_error.first()["rule"] == "empty_dataset" and done.clean.count() == 0


OUTPUT = {"category": "bug", "priority": "low", "sentiment": "neutral",
          "response": "Thank you for the report.", "next_action": "triage_report"}


def predictions(spark, ids, text=json.dumps(OUTPUT)):
    rows = [(str(i), n, OUTPUT, text, 1.0) for n, i in enumerate(ids)]
    return spark.createDataFrame(
        rows, f"id string, position long, expected {schemas.OUTPUT}, prediction string, latency_ms double"
    )


def test_parity_refuses_other_cohorts(spark):
    adapter = predictions(spark, range(20))
    done = evaluation.parity(adapter, predictions(spark, [0]))
    assert done.problems.count() == 19 and not any(r["passed"] for r in done.decisions.collect())
    for merged, problem in (
        (predictions(spark, [1, 0, *range(2, 20)]), "position differs"),
        (predictions(spark, [*range(20), 3]), "repeated in candidate"),
        (adapter.withColumn("model_revision", F.lit("b")), "model_revision differs"),
    ):
        one = adapter.withColumn("model_revision", F.lit("a")) if "model_revision" in merged.columns else adapter
        done = evaluation.parity(one, merged)
        assert problem in {r["problem"] for r in done.problems.collect()}
        assert not any(r["passed"] for r in done.decisions.collect())
    done = evaluation.parity(adapter, adapter)
    assert done.problems.count() == 0 and all(r["passed"] for r in done.decisions.collect())


def test_evaluation_refuses_unusable_rows(spark, tmp_path):
    good = {"id": "A", "expected": OUTPUT, "prediction": json.dumps(OUTPUT), "latency_ms": 1.0}
    bad = {"id": "B", "prediction": "{}", "latency_ms": 1.0}
    folder = written(tmp_path, {"p.jsonl": [json.dumps(good), json.dumps(bad), "no json"]})
    done = evaluation.evaluate(jsonl.read_predictions(spark, folder))
    assert sorted((r["line_no"], r["problem"]) for r in done.problems.collect())[0][0] == 2
    assert done.problems.count() == 2 and done.summary.first()["examples"] == 1
    assert not any(r["passed"] for r in done.decisions.collect())
    written(tmp_path, {"p.jsonl": [json.dumps(good)] * 2})
    done = evaluation.evaluate(jsonl.read_predictions(spark, folder))
    assert [r["problem"] for r in done.problems.collect()] == ["id repeated"]
    empty = predictions(spark, [])
    assert [r["problem"] for r in evaluation.evaluate(empty).problems.collect()] == ["no rows"]


def test_digest_has_one_root_above_the_level_count(spark):
    rows = spark.range(1100).select((F.col("id") % 2).alias("g"), F.floor(F.col("id") / 2).alias("p"), "id")
    line = F.col("id").cast("string")
    few = tree_digest(rows, ["g"], "p", line, fan_out=4, levels=2)
    many = tree_digest(rows, ["g"], "p", line, fan_out=4, levels=5)
    assert few.count() == 2 and {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()}
    assert [r["lines"] for r in few.collect()] == [550, 550]


def test_parity_refuses_unusable_rows_and_absent_lineage(spark):
    adapter = predictions(spark, range(20)).withColumn("model_revision", F.lit("a"))
    nothing = adapter.limit(0)
    bad = adapter.withColumn("problem", F.when(F.col("id") == "3", "not an object"))
    empty_id = adapter.withColumn("id", F.when(F.col("id") == "3", "").otherwise(F.col("id")))
    null_revision = adapter.withColumn("model_revision", F.when(F.col("id") != "3", "a"))
    for one, other, problem in (
        (adapter, bad, "merged: not an object"),
        (bad, adapter, "adapter: not an object"),
        (adapter, empty_id, "merged: id empty"),
        (nothing, nothing, "adapter: no rows"),
        (adapter, adapter.drop("model_revision"), "merged: model_revision absent"),
        (null_revision, null_revision, "adapter: model_revision absent"),
    ):
        done = evaluation.parity(one, other)
        assert problem in {r["problem"] for r in done.problems.collect()}, problem
        assert not any(r["passed"] for r in done.decisions.collect()), problem
    done = evaluation.parity(adapter, adapter)
    assert done.problems.count() == 0 and all(r["passed"] for r in done.decisions.collect())


def test_predictions_are_bound_to_held_out_rows(spark):
    rows = predictions(spark, range(10))
    bound = rows.withColumns(
        {"dataset_manifest_sha256": F.lit("m"), "dataset_split_sha256": F.lit("s"),
         "training_dataset_sha256": F.create_map(F.lit("test"), F.lit("s"))}
    )
    assert comparing.heldout_problems(bound, rows, "m", "s").count() == 0
    other = F.create_map(F.lit("test"), F.lit("x"))
    for made, problem in (
        (rows, "manifest digest differs"),
        (bound.drop("dataset_split_sha256"), "split digest differs"),
        (bound.withColumn("training_dataset_sha256", other), "training test digest differs"),
        (bound.where("id <> '4'"), "missing from predictions"),
        (bound.unionByName(bound.where("id = '4'")), "repeated in predictions"),
        (bound.withColumn("position", F.col("position") + 1), "position differs"),
    ):
        assert problem in {r["problem"] for r in comparing.heldout_problems(made, rows, "m", "s").collect()}
    no_training = bound.withColumn("training_dataset_sha256", F.lit(None).cast("map<string,string>"))
    assert comparing.heldout_problems(no_training, rows, "m", "s").count() == 0
