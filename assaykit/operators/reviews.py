"""Multi-reviewer qualification: draft packets, approvals, and the policy table.

Tables: ``source`` (position, id); ``prepared`` (split, position, id); ``freeze`` (position, id);
``packets`` (one row per packet: path, reviewer_id, status, review_date and the three digests it
binds, plus declared_sha256 and sha256 of its file); ``decisions`` (path, position, record_id and
the four outcomes). ``header`` is one row with the aggregate review manifest and observed digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv


def draft_decisions(
    records: DataFrame, record_id: str, position: str, reviewers: Sequence[str] = fv.DRAFT_REVIEWERS
) -> DataFrame:
    """One pending decision per record and reviewer; the reviewer list is a literal array."""
    return records.select(
        F.explode(F.array(*[F.lit(r) for r in reviewers])).alias("reviewer_id"),
        F.col(position).alias("position"),
        F.col(record_id).alias("record_id"),
        *[F.lit("pending").alias(field) for field in fv.REVIEW_FIELDS],
    )


def approved(row_of=F.col) -> Column:
    """All four outcomes are approved."""
    every = F.lit(True)
    for field in fv.REVIEW_FIELDS:
        every = every & F.coalesce(row_of(field) == "approved", F.lit(False))
    return every


def named_reviewer(reviewer_id: Column) -> Column:
    """The reviewer id is not a scaffold placeholder."""
    folded = F.lower(F.trim(reviewer_id))
    marked = F.lit(False)
    for marker in fv.PLACEHOLDER_MARKERS:
        marked = marked | F.contains(folded, F.lit(marker))
    return ~(
        reviewer_id.isin(*fv.DRAFT_REVIEWERS)
        | marked
        | folded.isin(*fv.PLACEHOLDER_REVIEWERS)
        | (F.startswith(folded, F.lit("<")) & F.endswith(folded, F.lit(">")))
    )


def decision_problems(decisions: DataFrame, packet: str = "path") -> DataFrame:
    """(packet, problem, cases): repeated record ids, id lengths and unknown outcomes."""
    unknown = F.lit(False)
    for field in fv.REVIEW_FIELDS:
        unknown = unknown | ~F.coalesce(F.col(field).isin(*fv.REVIEW_OUTCOMES), F.lit(False))
    rows = decisions.select(
        packet,
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.length("record_id").between(1, 200), F.lit("record id length")),
                    F.when(unknown, F.lit("unknown outcome")),
                )
            )
        ).alias("problem"),
    )
    repeated = (
        decisions.groupBy(packet, "record_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(packet, F.lit("repeated record id").alias("problem"))
    )
    return rows.unionByName(repeated).groupBy(packet, "problem").agg(
        F.count(F.lit(1)).alias("cases")
    )


def approved_by_all(decisions: DataFrame, packet: str = "path") -> DataFrame:
    """Records that every packet approves: an intersection, counted per record."""
    packets = decisions.select(packet).distinct().agg(F.count(F.lit(1)).alias("__packets"))
    voted = (
        decisions.where(approved())
        .groupBy("record_id", packet)
        .agg(F.lit(1).alias("one"))
        .groupBy("record_id")
        .agg(F.count(F.lit(1)).alias("__votes"))
        .withColumn("__k", F.lit(0))
    )
    return voted.join(F.broadcast(packets.withColumn("__k", F.lit(0))), "__k").where(
        F.col("__votes") == F.col("__packets")
    ).select("record_id")


def packet_order(decisions: DataFrame, source: DataFrame, packet: str = "path") -> DataFrame:
    """Per packet: decides every source record, each at its source position."""
    total = source.agg(F.count(F.lit(1)).alias("total")).withColumn("__k", F.lit(0))
    placed = decisions.select(packet, "position", "record_id").join(
        source.select("position", F.col("id").alias("record_id"), F.lit(1).alias("hit")),
        ["position", "record_id"],
        "left",
    )
    counts = placed.groupBy(packet).agg(
        F.count(F.lit(1)).alias("decided"), F.count("hit").alias("in_place")
    )
    return (
        counts.withColumn("__k", F.lit(0))
        .join(F.broadcast(total), "__k")
        .select(
            packet,
            "decided",
            "in_place",
            ((F.col("decided") == F.col("total")) & (F.col("in_place") == F.col("total"))).alias(
                "covers"
            ),
        )
    )


def _policy(name: str, passed: Column, observed: Column, required: Column | str) -> Column:
    needed = F.lit(required) if isinstance(required, str) else required.cast("string")
    return F.struct(
        F.lit(name).alias("policy"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.coalesce(observed.cast("string"), F.lit("")).alias("observed"),
        F.coalesce(needed, F.lit("")).alias("required"),
    )


def _facts(*tables: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables."""
    joined = tables[0].withColumn("__k", F.lit(0))
    for table in tables[1:]:
        joined = joined.join(table.withColumn("__k", F.lit(0)), "__k", "left")
    return joined.drop("__k")


def qualify(
    header: DataFrame,
    source: DataFrame,
    prepared: DataFrame,
    freeze: DataFrame,
    packets: DataFrame,
    decisions: DataFrame,
    min_records: int = fv.MIN_RECORDS,
    min_reviewers: int = fv.MIN_REVIEWERS,
    min_held_out: int = fv.MIN_HELD_OUT,
) -> DataFrame:
    """The 26 policy decisions (policy, passed, observed, required) of review schema 1.2.

    Header columns: schema_version, source_sha256 (declared), observed_source_sha256,
    record_count, total_examples, prepared_sha256 (declared), observed_prepared_sha256,
    prepared_source_sha256, freeze_sha256 (declared), observed_freeze_sha256,
    freeze_source_sha256, freeze_prepared_sha256, approval_status, review_date.
    """
    n = F.count(F.lit(1))
    counts = source.agg(n.alias("records"))
    partition = (
        prepared.groupBy("id").agg(n.alias("copies"))
        .join(source.select("id", F.lit(1).alias("known")), "id", "full_outer")
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("prepared_rows"),
            F.count("copies").alias("prepared_ids"),
            F.count_if(F.col("copies").isNull() | F.col("known").isNull()).alias("unmatched"),
        )
    )
    test = prepared.where(F.col("split") == "test").select("position", F.col("id").alias("test_id"))
    frozen = (
        freeze.select("position", F.col("id").alias("frozen_id"))
        .join(test, "position", "full_outer")
        .agg(
            F.count("frozen_id").alias("held_out"),
            F.count("test_id").alias("test_rows"),
            F.count_if(~F.col("frozen_id").eqNullSafe(F.col("test_id"))).alias("misplaced"),
        )
    )
    within = freeze.join(source.select("id"), "id", "left_semi").agg(n.alias("held_in_source"))
    named = packets.withColumn("named", named_reviewer(F.col("reviewer_id")))
    heads = named.withColumn("__k", F.lit(0)).join(
        F.broadcast(
            header.select(
                F.lit(0).alias("__k"),
                F.col("observed_source_sha256").alias("want_source"),
                F.col("observed_prepared_sha256").alias("want_prepared"),
                F.col("observed_freeze_sha256").alias("want_freeze"),
            )
        ),
        "__k",
    )
    reviewed = heads.agg(
        n.alias("packets"),
        F.count_distinct("path").alias("paths"),
        F.count_distinct("sha256").alias("digests"),
        F.count_if(F.col("declared_sha256") == F.col("sha256")).alias("hash_matches"),
        F.count_distinct("reviewer_id").alias("reviewers"),
        F.count_if("named").alias("named_reviewers"),
        F.count_if(F.col("source_sha256") == F.col("want_source")).alias("bind_source"),
        F.count_if(F.col("prepared_manifest_sha256") == F.col("want_prepared")).alias(
            "bind_prepared"
        ),
        F.count_if(F.col("holdout_freeze_sha256") == F.col("want_freeze")).alias("bind_freeze"),
        F.count_if((F.col("status") == "approved") & F.col("review_date").isNotNull()).alias(
            "approved_packets"
        ),
    )
    covering = packet_order(decisions, source).agg(F.count_if("covers").alias("covering"))
    votes = decisions.agg(F.bool_and(approved()).alias("every_decision"))
    unanimous = approved_by_all(decisions).agg(n.alias("unanimous"))
    facts = _facts(
        header, counts, partition, frozen, within, reviewed, covering, votes, unanimous
    )

    c = F.col
    dated = c("review_date").isNotNull()
    policies = [
        _policy("review_evidence_schema_v1_2", c("schema_version") == "1.2", c("schema_version"), "1.2"),
        _policy("source_sha256_matches", c("source_sha256") == c("observed_source_sha256"),
                c("source_sha256"), c("observed_source_sha256")),
        _policy("record_count_matches", c("record_count") == c("records"), c("record_count"), c("records")),
        _policy("minimum_record_count", c("records") >= min_records, c("records"), f">={min_records}"),
        _policy("prepared_manifest_sha256_matches",
                c("prepared_sha256") == c("observed_prepared_sha256"),
                c("prepared_sha256"), c("observed_prepared_sha256")),
        _policy("prepared_manifest_source_matches",
                c("prepared_source_sha256") == c("observed_source_sha256"),
                c("prepared_source_sha256"), c("observed_source_sha256")),
        _policy("prepared_manifest_record_ids_match",
                (c("prepared_rows") == c("records")) & (c("prepared_ids") == c("records"))
                & (c("unmatched") == 0) & (c("total_examples") == c("records")),
                c("prepared_ids"), c("records")),
        _policy("holdout_freeze_sha256_matches",
                c("freeze_sha256") == c("observed_freeze_sha256"),
                c("freeze_sha256"), c("observed_freeze_sha256")),
        _policy("holdout_freeze_matches_prepared_test",
                (c("freeze_source_sha256") == c("observed_source_sha256"))
                & (c("freeze_prepared_sha256") == c("observed_prepared_sha256"))
                & (c("misplaced") == 0),
                c("held_out"),
                F.format_string("exact ordered prepared test IDs (%d)", c("test_rows"))),
        _policy("minimum_independent_review_packets", c("packets") >= min_reviewers,
                c("packets"), f">={min_reviewers}"),
        _policy("review_packet_files_distinct",
                (c("paths") == c("packets")) & (c("digests") == c("packets")),
                F.format_string("paths=%d,digests=%d", c("paths"), c("digests")),
                "two distinct paths and two distinct file digests"),
        _policy("review_packet_hashes_match", c("hash_matches") == c("packets"),
                c("hash_matches"), c("packets")),
        _policy("reviewer_ids_distinct", c("reviewers") == c("packets"), c("reviewers"), c("packets")),
        _policy("reviewer_ids_non_placeholder", c("named_reviewers") == c("packets"),
                c("named_reviewers"), c("packets")),
        _policy("review_packets_bind_source", c("bind_source") == c("packets"),
                c("bind_source"), c("packets")),
        _policy("review_packets_bind_prepared_manifest", c("bind_prepared") == c("packets"),
                c("bind_prepared"), c("packets")),
        _policy("review_packets_bind_holdout_freeze", c("bind_freeze") == c("packets"),
                c("bind_freeze"), c("packets")),
        _policy("review_packets_cover_ordered_source", c("covering") == c("packets"),
                c("covering"), c("packets")),
        _policy("review_packets_approved", c("approved_packets") == c("packets"),
                c("approved_packets"), c("packets")),
        _policy("review_packet_decisions_approved", c("every_decision"), c("unanimous"), c("records")),
        _policy("full_record_review", c("unanimous") == c("records"), c("unanimous"), c("records")),
        _policy("minimum_held_out_examples", c("held_out") >= min_held_out,
                c("held_out"), f">={min_held_out}"),
        _policy("held_out_within_dataset", c("held_out") <= c("records"), c("held_out"),
                F.format_string("<=%d", c("records"))),
        _policy("held_out_count_matches_ids", c("held_out") == c("test_rows"),
                c("held_out"), c("test_rows")),
        _policy("held_out_ids_within_source", c("held_in_source") == c("held_out"),
                c("held_in_source"), c("held_out")),
        _policy("approved_status", (c("approval_status") == "approved") & dated,
                F.when(dated, c("approval_status")).otherwise(
                    F.concat(c("approval_status"), F.lit("; review_date=null"))),
                "approved with review_date"),
    ]
    return facts.select(F.explode(F.array(*policies)).alias("d")).select("d.*")


def qualify_legacy(
    header: DataFrame,
    source: DataFrame,
    held_out: DataFrame,
    min_records: int = fv.MIN_RECORDS,
    min_reviewers: int = fv.MIN_REVIEWERS,
    min_held_out: int = fv.MIN_HELD_OUT,
) -> DataFrame:
    """Decisions of review schema 1.1. Its counts are self-asserted, so it never qualifies:
    the policies that need packet evidence are always failed.

    Header columns: source_sha256, observed_source_sha256, record_count,
    independent_reviewer_count, reviewed_count, held_out_count, approval_status.
    """
    n = F.count(F.lit(1))
    facts = _facts(
        header,
        source.agg(n.alias("records")),
        held_out.agg(n.alias("held_out")),
        held_out.join(source.select("id"), "id", "left_semi").agg(n.alias("held_in_source")),
    )
    c = F.col
    own = [
        _policy("source_sha256_matches", c("source_sha256") == c("observed_source_sha256"),
                c("source_sha256"), c("observed_source_sha256")),
        _policy("record_count_matches", c("record_count") == c("records"), c("record_count"), c("records")),
        _policy("minimum_record_count", c("records") >= min_records, c("records"), f">={min_records}"),
        _policy("minimum_independent_reviewers", F.lit(False),
                F.format_string("self_asserted_count=%d", c("independent_reviewer_count")),
                f">={min_reviewers} verified reviewer packets"),
        _policy("full_record_review", c("reviewed_count") == c("records"), c("reviewed_count"), c("records")),
        _policy("minimum_held_out_examples", c("held_out") >= min_held_out, c("held_out"), f">={min_held_out}"),
        _policy("held_out_within_dataset", c("held_out") <= c("records"), c("held_out"),
                F.format_string("<=%d", c("records"))),
        _policy("held_out_count_matches_ids", c("held_out_count") == c("held_out"),
                c("held_out_count"), c("held_out")),
        _policy("held_out_ids_within_source", c("held_in_source") == c("held_out"),
                c("held_in_source"), c("held_out")),
        _policy("approved_status", c("approval_status") == "approved", c("approval_status"), "approved"),
    ]
    packet_only = [
        name for name in fv.CURRENT_POLICIES if name not in fv.LEGACY_POLICIES
    ]
    failed = [
        _policy(name, F.lit(False), F.lit("not_present_in_v1.1"), "transitively_hashed_v1.2_evidence")
        for name in packet_only
    ]
    return facts.select(F.explode(F.array(*own, *failed)).alias("d")).select("d.*")


def qualification_result(policies: DataFrame, records: DataFrame, legacy: bool = False) -> DataFrame:
    """(qualified, dataset_tier, failed policies)."""
    passed = policies.agg(
        (F.bool_and("passed") & F.lit(not legacy)).alias("qualified"),
        F.count_if(~F.col("passed")).alias("failed_policies"),
    )
    tier = records.agg(
        F.when(F.count(F.lit(1)) >= fv.MIN_RECORDS, fv.TIER_CANDIDATE)
        .otherwise(fv.TIER_SMOKE)
        .alias("dataset_tier")
    )
    return _facts(passed, tier)


def _one_digest(inventory: DataFrame, out: str) -> DataFrame:
    """One digest per path; a path with several contents has none."""
    least, most = F.min("sha256"), F.max("sha256")
    return inventory.groupBy("path").agg(F.when(least == most, least).alias(out))


def reference_checks(references: DataFrame, inventory: DataFrame) -> DataFrame:
    """Declared against observed digest of each referenced file; a missing file fails."""
    seen = _one_digest(inventory, "observed_sha256")
    return references.join(seen, "path", "left").withColumn(
        "matches", F.coalesce(F.col("sha256") == F.col("observed_sha256"), F.lit(False))
    )


def rebind_references(references: DataFrame, inventory: DataFrame) -> DataFrame:
    """References with the digest the file has now; decisions and status are not touched."""
    seen = _one_digest(inventory, "__now")
    return references.join(seen, "path", "left").withColumn("sha256", F.col("__now")).drop("__now")
