"""Functional parity of two prediction sets over one ordered cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions import strict_json as sj
from assaykit.functions.stages import with_computed

MISMATCH_KINDS = (
    "adapter_schema_invalid",
    "merged_schema_invalid",
    "category",
    "priority",
    "sentiment",
    "next_action",
    "response",
    "raw_prediction",
    "parsed_object",
)


def _parsed(predictions: DataFrame, side: str) -> DataFrame:
    """Only a bare strict JSON object counts; nothing is recovered, so this stays in the JVM.

    Texts are compared by digest, so the join moves short rows however long the answers are.
    """
    value = sj.parse_object(F.col("prediction"))
    parsed = with_computed(predictions.select("id", "position", "prediction"), {"value": value})
    parsed = with_computed(parsed, {"members": sj.members_of(F.col("value"))})
    read = with_computed(parsed, {"out": sj.output_members(F.col("members"))})
    valid = F.coalesce(sj.field_errors(F.col("out"), F.col("members")) == 0, F.lit(False))
    return read.select(
        "id",
        F.col("position").alias(f"{side}_position"),
        F.sha2("prediction", 256).alias(f"{side}_text"),
        F.sha2(F.to_json("value"), 256).alias(f"{side}_json"),
        F.struct(*[sj.trimmed_output(F.col("out"))[name].alias(name)
                   for name in fv.ROUTING_FIELDS]).alias(f"{side}_out"),
        F.sha2(F.col("out")["response"], 256).alias(f"{side}_response"),
        valid.alias(f"{side}_valid"),
    )


def _one_per_id(rows: DataFrame) -> DataFrame:
    """First row per id. Ids are unique in a usable set; this keeps repeats from multiplying."""
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("row")).select("id", "row.*")


def pair_predictions(adapter: DataFrame, merged: DataFrame) -> DataFrame:
    """One row per id with all match flags. Inputs: (id, position, prediction)."""
    pairs = _one_per_id(_parsed(adapter, "a")).join(_one_per_id(_parsed(merged, "m")), "id")
    contract = F.col("a_valid") & F.col("m_valid")
    objects = F.col("a_json").isNotNull() & F.col("m_json").isNotNull()
    flags: dict[str, Column] = {
        "contract": contract,
        "objects": objects,
        "raw_match": F.col("a_text") == F.col("m_text"),
        "object_match": objects & F.coalesce(F.col("a_json") == F.col("m_json"), F.lit(False)),
        "response_match": contract
        & F.coalesce(F.col("a_response") == F.col("m_response"), F.lit(False)),
    }
    for name in fv.ROUTING_FIELDS:
        same = F.col(f"a_out.{name}") == F.col(f"m_out.{name}")
        flags[f"{name}_match"] = contract & F.coalesce(same, F.lit(False))
    routing = F.lit(True)
    for name in fv.ROUTING_FIELDS:
        routing = routing & F.col(f"{name}_match")
    return pairs.select(
        "id", "a_position", "m_position", "a_valid", "m_valid",
        *[flag.alias(name) for name, flag in flags.items()],
    ).withColumn("routing_match", routing)


def parity_metrics(pairs: DataFrame) -> DataFrame:
    """Count and the ten rates in one aggregation."""
    rates = {
        "adapter_schema_valid_rate": "a_valid",
        "merged_schema_valid_rate": "m_valid",
        "category_match_rate": "category_match",
        "priority_match_rate": "priority_match",
        "sentiment_match_rate": "sentiment_match",
        "next_action_match_rate": "next_action_match",
        "routing_match_rate": "routing_match",
        "response_exact_rate": "response_match",
        "raw_prediction_exact_rate": "raw_match",
        "parsed_object_exact_rate": "object_match",
    }
    return pairs.agg(
        F.count(F.lit(1)).alias("examples"),
        *[F.avg(F.col(flag).cast("double")).alias(rate) for rate, flag in rates.items()],
    )


def parity_decisions(metrics: DataFrame) -> DataFrame:
    """Seven gates; each needs a rate of exactly 1."""
    rows = metrics.unpivot([], list(fv.PARITY_GATES), "metric", "value")
    return rows.select(
        "metric", "value", F.lit(1.0).alias("required"), (F.col("value") == 1.0).alias("passed")
    )


def mismatches(pairs: DataFrame) -> DataFrame:
    """(kind, id, position) rows in cohort order of ``position``.

    Field mismatches are listed for pairs where both sides keep the schema; other pairs are
    listed as invalid.
    """
    bad: dict[str, Column] = {
        "adapter_schema_invalid": ~F.col("a_valid"),
        "merged_schema_invalid": ~F.col("m_valid"),
        "contract_invalid": ~F.col("contract"),
        "response": F.col("contract") & ~F.col("response_match"),
        "raw_prediction": ~F.col("raw_match"),
        "parsed_object": F.col("objects") & ~F.col("object_match"),
        "routing": F.col("contract") & ~F.col("routing_match"),
        "release_blocked": ~F.col("contract") | ~F.col("routing_match"),
    }
    for name in fv.ROUTING_FIELDS:
        bad[name] = F.col("contract") & ~F.col(f"{name}_match")
    kinds = F.array_compact(F.array(*[F.when(flag, F.lit(kind)) for kind, flag in bad.items()]))
    return pairs.select(F.explode(kinds).alias("kind"), "id", F.col("a_position").alias("position"))


def lineage_problems(rows: DataFrame, role: str) -> DataFrame:
    """(id, problem) rows of a generated prediction set whose lineage is not consistent.

    ``role`` is ``adapter`` or ``merged``. Columns are those of the generated prediction schema.
    """
    def absent(name: str) -> Column:
        return F.col(name).isNull()

    def empty(name: str) -> Column:
        return F.coalesce(F.size(name) <= 0, F.lit(True))

    dataset = F.col("training_dataset_sha256")
    present = [~absent("training_manifest_sha256"), ~absent("training_config_sha256"),
               ~empty("training_dataset_sha256")]
    some, every = present[0] | present[1] | present[2], present[0] & present[1] & present[2]
    missing_keys = F.size(
        F.array_except(F.array(*[F.lit(k) for k in fv.LINEAGE_DATASET_KEYS]), F.map_keys(dataset))
    ) > 0
    wanted = F.map_filter(dataset, lambda k, _: F.startswith(k, F.lit(fv.QUALIFICATION_PREFIX)))
    checks: list[tuple[str, Column]] = [
        ("dataset manifest digest missing", absent("dataset_manifest_sha256")),
        ("dataset split digest missing", absent("dataset_split_sha256")),
        ("generation config digest missing", absent("generation_config_sha256")),
        ("training lineage incomplete", some & ~every),
        ("training dataset digests incomplete", ~empty("training_dataset_sha256") & missing_keys),
        ("training manifest digest differs from dataset", ~empty("training_dataset_sha256")
         & ~dataset["manifest"].eqNullSafe(F.col("dataset_manifest_sha256"))),
        ("training test digest differs from split", ~empty("training_dataset_sha256")
         & ~dataset["test"].eqNullSafe(F.col("dataset_split_sha256"))),
        ("qualification digests differ from training lineage",
         ~_entries("qualification_sha256").eqNullSafe(_sorted_entries(wanted))),
    ]
    if role == "adapter":
        checks += [
            ("adapter identity incomplete",
             F.coalesce(F.col("adapter_path") == "", F.lit(True)) | absent("adapter_config_sha256")
             | empty("adapter_weight_sha256")),
            ("adapter rows declare a merged model",
             ~absent("merged_model_path") | ~absent("merge_provenance_sha256")
             | ~empty("merged_artifact_sha256") | ~absent("merged_adapter_config_sha256")
             | ~empty("merged_adapter_weight_files") | ~empty("merged_adapter_weight_sha256")),
        ]
    else:
        files, hashes = F.col("merged_adapter_weight_files"), F.col("merged_adapter_weight_sha256")
        checks += [
            ("merged identity incomplete",
             F.coalesce(F.col("merged_model_path") == "", F.lit(True))
             | absent("merge_provenance_sha256") | empty("merged_artifact_sha256")
             | absent("merged_adapter_config_sha256") | empty("merged_adapter_weight_files")
             | empty("merged_adapter_weight_sha256")),
            ("merged rows declare an adapter",
             ~absent("adapter_path") | ~absent("adapter_config_sha256")
             | ~empty("adapter_weight_sha256")),
            ("merged weight lineage invalid",
             ~F.size(files).eqNullSafe(F.size(hashes))
             | (F.size(F.array_distinct(files)) != F.size(files))),
        ]
    found = F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks])
    )
    return rows.select("id", F.explode(found).alias("problem"))


def same_weights(adapter: Column, files: Column, hashes: Column) -> Column:
    """A map of adapter weights equals the merged side's parallel lists of names and digests."""
    left = F.array_sort(
        F.transform(F.map_entries(adapter), lambda e: F.concat_ws("=", e["key"], e["value"]))
    )
    right = F.array_sort(F.zip_with(files, hashes, lambda f, h: F.concat_ws("=", f, h)))
    return left.eqNullSafe(right)


def _sorted_entries(column: Column) -> Column:
    return F.array_sort(F.map_entries(F.coalesce(column, F.create_map().cast("map<string,string>"))))


def _entries(name: str) -> Column:
    return _sorted_entries(F.col(name))


def single_value_problems(rows: DataFrame, columns: list[str], position: str) -> DataFrame:
    """(field, first_position): the first row whose value differs from the first row's value.

    Values are counted per field before any shuffle, so only distinct values move.
    """
    texts = [
        F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}).alias(c)
        for c in columns
    ]
    seen = (
        rows.select(F.col(position).alias("__at"), *texts)
        .unpivot(["__at"], columns, "field", "value")
        .groupBy("field", "value")
        .agg(F.min("__at").alias("__at"))
    )
    first = seen.groupBy("field").agg(F.min("__at").alias("__first"))
    return (
        seen.join(first, "field")
        .where(F.col("__at") > F.col("__first"))
        .groupBy("field")
        .agg(F.min("__at").alias("first_position"))
    )


def mixed_presence(rows: DataFrame, column: str) -> DataFrame:
    """Rows with and without the value; a set that has both is refused."""
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(column).alias("present"),
        (F.count(column).isin(0) | (F.count(column) == F.count(F.lit(1)))).alias("consistent"),
    )
