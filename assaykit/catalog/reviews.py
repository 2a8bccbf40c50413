"""Registered review and evidence queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.catalog import derived as d
from assaykit.catalog.splits import _SIMPLE, split_simple
from assaykit.functions import text as tx
from assaykit.operators import audits, evidence, reviews
from assaykit.session import durable
from assaykit.sources import inventory, sinks
from assaykit.tables import read_table

PACKETS = ("reviews/first.json", "reviews/second.json")


def _source(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return docs.select(F.col("doc_id").alias("position"), d.record_id(F.col("doc_id")).alias("id"))


def _decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Both packets decide every record; the second rejects a few, and swaps one place."""
    n = F.col("position")
    second = F.col("path") == PACKETS[1]
    return _source(spark, folder).select(
        F.explode(F.array(*[F.lit(p) for p in PACKETS])).alias("path"), "position", F.col("id").alias("record_id")
    ).select(
        "path",
        F.when(second & (n == 5), 6).when(second & (n == 6), 5).otherwise(n).alias("position"),
        "record_id",
        F.when(second & (n % 211 == 0), "rejected").otherwise("approved").alias("labels"),
        F.when(~second & (n % 307 == 0), "pending").otherwise("approved").alias("response"),
        F.lit("approved").alias("pii"),
        F.lit("approved").alias("license"),
    )


def draft_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.draft_decisions(_source(spark, folder), "id", "position")


def approved_by_all(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.approved_by_all(_decisions(spark, folder))


def packet_order(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.packet_order(_decisions(spark, folder), _source(spark, folder))


def decision_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Review rows with repeated ids, an empty id and an unknown outcome."""
    rows = _decisions(spark, folder)
    n = F.col("position")
    bad = rows.withColumn("labels", F.when(n % 71 == 0, "maybe").otherwise(F.col("labels"))).withColumn(
        "record_id", F.when(n % 113 == 0, "").otherwise(F.col("record_id"))
    )
    return reviews.decision_problems(bad.unionByName(bad.where(n % 59 == 1)))


def reviewer_names(spark: SparkSession, folder: str) -> DataFrame:
    """Which customer names could stand as reviewer ids; some are turned into placeholders."""
    key = F.col("c_custkey")
    name = (
        F.when(key % 11 == 0, F.concat(F.lit("<"), F.col("c_name"), F.lit(">")))
        .when(key % 11 == 1, F.concat(F.lit("TODO "), F.col("c_name")))
        .when(key % 11 == 2, "Reviewer-A")
        .when(key % 11 == 3, fv.DRAFT_REVIEWERS[0])
        .otherwise(F.col("c_name"))
    )
    rows = read_table(spark, folder, "customer").select("c_custkey", reviews.named_reviewer(name).alias("named"))
    return rows.groupBy("named").agg(F.count(F.lit(1)).alias("customers"), F.min("c_custkey").alias("first_key"))


def _header(spark: SparkSession, folder: str) -> DataFrame:
    """Aggregate manifest derived from the corpus; one declared digest is stale."""
    docs = read_table(spark, folder, "documents")
    counted = docs.agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    source = F.sha2(F.concat_ws(":", F.lit("source"), "n", "chars"), 256)
    prepared = F.sha2(F.concat_ws(":", F.lit("prepared"), "n", "chars"), 256)
    freeze = F.sha2(F.concat_ws(":", F.lit("freeze"), "n", "chars"), 256)
    return counted.select(
        F.lit("1.2").alias("schema_version"),
        source.alias("source_sha256"),
        source.alias("observed_source_sha256"),
        F.col("n").alias("record_count"),
        F.col("n").alias("total_examples"),
        prepared.alias("prepared_sha256"),
        prepared.alias("observed_prepared_sha256"),
        source.alias("prepared_source_sha256"),
        F.sha2(F.lit("stale"), 256).alias("freeze_sha256"),
        freeze.alias("observed_freeze_sha256"),
        source.alias("freeze_source_sha256"),
        prepared.alias("freeze_prepared_sha256"),
        F.lit("approved").alias("approval_status"),
        F.lit(None).cast("date").alias("review_date"),
    )


def review_policies(spark: SparkSession, folder: str) -> DataFrame:
    placed = split_simple(spark, folder).select(
        "split", "position", d.record_id(F.col("id")).alias("id")
    )
    header = _header(spark, folder)
    packets = header.select(
        F.explode(F.array(*[F.lit(p) for p in PACKETS])).alias("path"),
        F.col("source_sha256"),
        F.col("prepared_sha256").alias("prepared_manifest_sha256"),
        F.col("observed_freeze_sha256").alias("holdout_freeze_sha256"),
    ).select(
        "path",
        F.when(F.col("path") == PACKETS[0], "Kim Doe").otherwise("Example Person").alias("reviewer_id"),
        F.lit("approved").alias("status"),
        F.to_date(F.lit("2026-01-05")).alias("review_date"),
        "source_sha256",
        "prepared_manifest_sha256",
        "holdout_freeze_sha256",
        F.sha2("path", 256).alias("declared_sha256"),
        F.sha2("path", 256).alias("sha256"),
    )
    freeze = placed.where("split = 'test'").select("position", "id")
    return reviews.qualify(
        header, _source(spark, folder), placed, freeze, packets, _decisions(spark, folder)
    )


def review_policies_legacy(spark: SparkSession, folder: str) -> DataFrame:
    header = _header(spark, folder).select(
        "source_sha256", "observed_source_sha256", "record_count",
        F.lit(2).alias("independent_reviewer_count"), F.col("record_count").alias("reviewed_count"),
        F.lit(50).alias("held_out_count"), "approval_status",
    )
    held = split_simple(spark, folder).where("split = 'test'").select(d.record_id(F.col("id")).alias("id"))
    return reviews.qualify_legacy(header, _source(spark, folder), held)


def page_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.content_inventory(
        read_table(spark, folder, "pages"), F.col("url"), F.col("html")
    )


def _declared(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    n = F.col("page_id")
    declared = inventory.content_inventory(
        pages.where(n % 31 != 0),
        F.when(n % 29 == 0, F.concat(F.col("url"), F.lit("#old"))).otherwise(F.col("url")),
        F.when(n % 23 == 0, F.concat(F.col("html"), F.lit(" "))).otherwise(F.col("html")),
    )
    return declared


def inventory_diff(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.inventory_diff(_declared(spark, folder), page_inventory(spark, folder))


def reference_checks(spark: SparkSession, folder: str) -> DataFrame:
    """References checked against the inventory, and how many a rebind changes."""
    observed = page_inventory(spark, folder)
    checked = reviews.reference_checks(_declared(spark, folder).select("path", "sha256"), observed)
    rebound = reviews.rebind_references(checked.select("path", F.col("sha256").alias("before"), "sha256", "matches"), observed)
    return rebound.groupBy("matches").agg(
        F.count(F.lit(1)).alias("references"),
        F.count_if(F.col("sha256").isNull()).alias("unresolved"),
        F.count_if(F.col("sha256") != F.col("before")).alias("rebound"),
    )


def evidence_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Page paths as evidence paths; some are absolute or climb out."""
    n = F.col("page_id")
    bare = F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), r"[?#].*$", "")
    path = (
        F.when(n % 10 == 0, F.concat(F.lit("/"), bare))
        .when(n % 10 == 1, F.concat(bare, F.lit("/../x")))
        .when(n % 10 == 2, F.concat(F.lit("./"), bare))
        .otherwise(bare)
    )
    home = F.when(n % 7 == 0, F.concat(F.col("html"), F.lit(" C:\\Users\\me /home/me"))).otherwise(F.col("html"))
    rows = read_table(spark, folder, "pages").select(
        tx.relative_path_ok(path).alias("path_ok"), tx.local_user_path(home).alias("user_path")
    )
    return rows.groupBy("path_ok", "user_path").agg(F.count(F.lit(1)).alias("pages"))


def digest_maps(spark: SparkSession, folder: str) -> DataFrame:
    """Digest maps per page with filler, malformed and missing digests."""
    n = F.col("page_id")
    good = F.sha2("html", 256)
    digests = (
        F.when(n % 9 == 0, F.create_map().cast("map<string,string>"))
        .when(n % 9 == 1, F.create_map(F.lit("page"), F.repeat(F.lit("a"), 64)))
        .when(n % 9 == 2, F.create_map(F.lit("page"), F.upper(good)))
        .otherwise(F.create_map(F.lit("page"), good))
    )
    rows = read_table(spark, folder, "pages").select("page_id", digests.alias("digests"))
    return audits.digest_map_problems(rows, "page_id", "digests")


def header_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """Line items against the header of their order."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").alias("year"),
    )
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linestatus").alias("status"),
        F.year("l_shipdate").alias("year"),
    )
    return audits.header_mismatches(lines, orders, ["status", "year"], "key")


def lineage_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Digest edges from documents to their labels' copy of the digest."""
    docs = read_table(spark, folder, "documents")
    labels = read_table(spark, folder, "labels")
    declared = labels.join(docs, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 0, F.sha2("lang", 256)).otherwise(F.sha2("text", 256)).alias("declared")
    )
    edges = docs.select("doc_id", F.sha2("text", 256).alias("observed")).join(declared, "doc_id", "left")
    return audits.lineage_checks(edges).groupBy("passed").agg(F.count(F.lit(1)).alias("edges"))


def evidence_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Claims between sources, splits, manifests, predictions and reports per language, with faults.

    Planted: a manifest of another source (de), predictions that name two test splits (fr), a report
    of predictions that are not there (es), predictions without a digest (en), two drafts that rest
    on each other, and a note that claims nothing.
    """
    docs = read_table(spark, folder, "documents").select(
        "lang", "doc_id", "text",
        F.when(F.col("doc_id") % 10 == 0, "test").when(F.col("doc_id") % 10 == 1, "validation")
        .otherwise("train").alias("split"),
    )
    tests = docs.where("split = 'test'").withColumn("line", F.concat_ws(":", "doc_id", F.length("text")))
    sources = evidence.observed("source", docs, "doc_id", F.col("text"), ["lang"])
    splits = evidence.observed("split", docs, "doc_id", F.col("text"), ["lang", "split"])
    made = evidence.observed("predictions", tests, "doc_id", F.col("line"), ["lang"])
    first = durable(sources.unionByName(splits).unionByName(made))
    lang, kind = F.split_part("name", F.lit(":"), F.lit(2)), F.substring_index("name", ":", 1)
    lines = first.where(kind != "predictions").select(
        lang.alias("lang"), "name", "digest",
        F.when(kind == "source", 0).when(F.endswith("name", F.lit("train")), 1)
        .when(F.endswith("name", F.lit("validation")), 2).otherwise(3).alias("position"),
    )
    lines = lines.withColumn(
        "digest",
        F.when((F.col("lang") == "de") & (kind == "source"), F.sha2("digest", 256)).otherwise(F.col("digest")),
    )
    manifests = durable(evidence.observed("manifest", lines, "position", F.col("digest"), ["lang"]))
    reports = made.select(F.replace("name", F.lit("predictions"), F.lit("report")).alias("name"), "digest")
    extra = spark.createDataFrame(
        [(name, "0" * 64) for name in ("draft:a", "draft:b", "note")], "name string, digest string"
    )
    nodes = first.unionByName(manifests).unionByName(reports).unionByName(extra)

    of_manifest = evidence.claims(
        lines, evidence.artifact("manifest", "lang"), {"content": (F.col("name"), F.col("digest"))}
    ).withColumn("role", F.concat_ws(":", "role", "parent"))
    held = tests.select("lang", "doc_id").join(
        splits.where(F.endswith("name", F.lit(":test"))).select(lang.alias("lang"), F.col("digest").alias("test_digest")), "lang"
    ).join(manifests.select(lang.alias("lang"), F.col("digest").alias("manifest_digest")), "lang")
    other = F.when((F.col("lang") == "fr") & (F.col("doc_id") % 20 == 0), F.sha2("test_digest", 256))
    missing = (F.col("lang") == "en") & (F.col("doc_id") % 20 == 0)
    of_predictions = evidence.claims(
        held, evidence.artifact("predictions", "lang"),
        {
            "split": (F.concat_ws(":", F.lit("split"), "lang", F.lit("test")), F.coalesce(other, "test_digest")),
            "manifest": (evidence.artifact("manifest", "lang"), F.when(~missing, F.col("manifest_digest"))),
        },
    )
    of_splits = evidence.claims(
        splits.select("name", lang.alias("lang")).join(sources.select(lang.alias("lang"), "digest"), "lang"),
        F.col("name"), {"source": (evidence.artifact("source", "lang"), F.col("digest"))},
    )
    old = F.when(lang == "es", F.lit("-old")).otherwise("")
    of_reports = evidence.claims(
        made.withColumn("lang", lang), evidence.artifact("report", "lang"),
        {"predictions": (F.concat("name", old), F.col("digest"))},
    )
    of_drafts = evidence.claims(
        extra.where("name <> 'note'"), F.col("name"),
        {"draft": (F.when(F.col("name") == "draft:a", "draft:b").otherwise("draft:a"), F.col("digest"))},
    )
    edges = reduce(DataFrame.unionByName, (of_manifest, of_predictions, of_splits, of_reports, of_drafts))
    return evidence.walk(nodes, edges, ["source"])


def table_equality(spark: SparkSession, folder: str) -> DataFrame:
    """Rows missing from and added to a copy of the line items."""
    lines = read_table(spark, folder, "lineitem")
    key = F.col("l_orderkey")
    copy = lines.where(key % 211 != 0).unionByName(lines.where(key % 223 == 0))
    return sinks.same_rows(lines, copy)


QUERIES = {
    "draft_reviews": draft_reviews,
    "approved_by_all": approved_by_all,
    "packet_order": packet_order,
    "decision_problems": decision_problems,
    "reviewer_names": reviewer_names,
    "review_policies": review_policies,
    "review_policies_legacy": review_policies_legacy,
    "page_inventory": page_inventory,
    "inventory_diff": inventory_diff,
    "reference_checks": reference_checks,
    "evidence_paths": evidence_paths,
    "digest_maps": digest_maps,
    "header_mismatches": header_mismatches,
    "lineage_checks": lineage_checks,
    "evidence_chain": evidence_chain,
    "table_equality": table_equality,
}

_ID = "printf('DOC-%08d', doc_id)"
_DECIDED = f"""decided AS (
  SELECT path, doc_id AS n, {_ID} AS record_id,
    CASE WHEN path = '{PACKETS[1]}' AND doc_id = 5 THEN 6 WHEN path = '{PACKETS[1]}' AND doc_id = 6 THEN 5
         ELSE doc_id END AS position,
    NOT (path = '{PACKETS[1]}' AND doc_id % 211 = 0) AND NOT (path = '{PACKETS[0]}' AND doc_id % 307 = 0) AS yes
  FROM documents, (SELECT unnest(['{PACKETS[0]}', '{PACKETS[1]}']) AS path))"""
_INV = "SELECT url AS path, sha256(html) AS sha256, strlen(html) AS size_bytes FROM pages"
_DECL = """SELECT CASE WHEN page_id % 29 = 0 THEN url || '#old' ELSE url END AS path,
  sha256(CASE WHEN page_id % 23 = 0 THEN html || ' ' ELSE html END) AS sha256,
  strlen(html) + CASE WHEN page_id % 23 = 0 THEN 1 ELSE 0 END AS size_bytes FROM pages WHERE page_id % 31 <> 0"""


def _policy_sql() -> str:
    rows = {
        "review_evidence_schema_v1_2": ("true", "'1.2'", "'1.2'"),
        "source_sha256_matches": ("true", "src", "src"),
        "record_count_matches": ("true", "n", "n"),
        "minimum_record_count": ("n >= 1000", "n", "'>=1000'"),
        "prepared_manifest_sha256_matches": ("true", "prep", "prep"),
        "prepared_manifest_source_matches": ("true", "src", "src"),
        "prepared_manifest_record_ids_match": ("true", "n", "n"),
        "holdout_freeze_sha256_matches": ("false", "sha256('stale')", "frz"),
        "holdout_freeze_matches_prepared_test": ("true", "held", "'exact ordered prepared test IDs (' || held || ')'"),
        "minimum_independent_review_packets": ("true", "2", "'>=2'"),
        "review_packet_files_distinct": ("true", "'paths=2,digests=2'", "'two distinct paths and two distinct file digests'"),
        "review_packet_hashes_match": ("true", "2", "2"),
        "reviewer_ids_distinct": ("true", "2", "2"),
        "reviewer_ids_non_placeholder": ("false", "1", "2"),
        "review_packets_bind_source": ("true", "2", "2"),
        "review_packets_bind_prepared_manifest": ("true", "2", "2"),
        "review_packets_bind_holdout_freeze": ("true", "2", "2"),
        "review_packets_cover_ordered_source": ("false", "1", "2"),
        "review_packets_approved": ("true", "2", "2"),
        "review_packet_decisions_approved": ("unanimous = n", "unanimous", "n"),
        "full_record_review": ("unanimous = n", "unanimous", "n"),
        "minimum_held_out_examples": ("held >= 100", "held", "'>=100'"),
        "held_out_within_dataset": ("true", "held", "'<=' || n"),
        "held_out_count_matches_ids": ("true", "held", "held"),
        "held_out_ids_within_source": ("true", "held", "held"),
        "approved_status": ("false", "'approved; review_date=null'", "'approved with review_date'"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS policy, {ok} AS passed, CAST({seen} AS VARCHAR) AS observed, "
        f"CAST({need} AS VARCHAR) AS required FROM facts"
        for name, (ok, seen, need) in rows.items()
    )


def _legacy_sql() -> str:
    rows = {
        "source_sha256_matches": ("true", "src", "src"),
        "record_count_matches": ("true", "n", "n"),
        "minimum_record_count": ("n >= 1000", "n", "'>=1000'"),
        "minimum_independent_reviewers": ("false", "'self_asserted_count=2'", "'>=2 verified reviewer packets'"),
        "full_record_review": ("true", "n", "n"),
        "minimum_held_out_examples": ("held >= 100", "held", "'>=100'"),
        "held_out_within_dataset": ("true", "held", "'<=' || n"),
        "held_out_count_matches_ids": ("held = 50", "50", "held"),
        "held_out_ids_within_source": ("true", "held", "held"),
        "approved_status": ("true", "'approved'", "'approved'"),
    }
    for name in fv.CURRENT_POLICIES:
        rows.setdefault(name, ("false", "'not_present_in_v1.1'", "'transitively_hashed_v1.2_evidence'"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS policy, {ok} AS passed, CAST({seen} AS VARCHAR) AS observed, "
        f"CAST({need} AS VARCHAR) AS required FROM facts"
        for name, (ok, seen, need) in rows.items()
    )


_FACTS = f"""{_SIMPLE}, {_DECIDED},
facts AS (SELECT n, held, unanimous, sha256('source:' || n || ':' || chars) AS src,
  sha256('prepared:' || n || ':' || chars) AS prep, sha256('freeze:' || n || ':' || chars) AS frz
  FROM (SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents),
       (SELECT count(*) AS held FROM simple WHERE split = 'test'),
       (SELECT count(*) AS unanimous FROM (SELECT record_id FROM decided WHERE yes GROUP BY 1 HAVING count(*) = 2)))"""

ORACLES = {
    "draft_reviews": f"""
SELECT r AS reviewer_id, doc_id AS position, {_ID} AS record_id, 'pending' AS labels, 'pending' AS response,
  'pending' AS pii, 'pending' AS license
FROM documents, (SELECT unnest(['{fv.DRAFT_REVIEWERS[0]}', '{fv.DRAFT_REVIEWERS[1]}']) AS r)""",
    "approved_by_all": f"""WITH {_DECIDED}
SELECT record_id FROM decided WHERE yes GROUP BY record_id HAVING count(DISTINCT path) = 2""",
    "packet_order": f"""WITH {_DECIDED}
SELECT path, count(*) AS decided, count(*) FILTER (position = n) AS in_place, bool_and(position = n) AS covers
FROM decided GROUP BY path""",
    "decision_problems": f"""WITH {_DECIDED},
one AS (SELECT path, position AS n, CASE WHEN position % 113 = 0 THEN '' ELSE record_id END AS rid FROM decided),
r AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE n % 59 = 1)
SELECT path, 'record id length' AS problem, count(*) AS cases FROM r WHERE rid = '' GROUP BY 1
UNION ALL SELECT path, 'unknown outcome', count(*) FROM r WHERE n % 71 = 0 GROUP BY 1
UNION ALL SELECT path, 'repeated record id', count(*) FROM
  (SELECT path, rid FROM r GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""",
    "reviewer_names": """
SELECT c_custkey % 11 > 3 AS named, count(*) AS customers, min(c_custkey) AS first_key FROM customer GROUP BY 1""",
    "review_policies": f"WITH {_FACTS} {_policy_sql()}",
    "review_policies_legacy": f"WITH {_FACTS} {_legacy_sql()}",
    "page_inventory": _INV,
    "inventory_diff": f"""WITH o AS ({_INV}), l AS ({_DECL})
SELECT path, CASE WHEN o.sha256 IS NULL THEN 'missing' WHEN l.sha256 IS NULL THEN 'unexpected'
  WHEN o.sha256 = l.sha256 AND o.size_bytes = l.size_bytes THEN 'same' ELSE 'changed' END AS status
FROM l FULL JOIN o USING (path)""",
    "reference_checks": f"""WITH o AS ({_INV}), l AS ({_DECL})
SELECT coalesce(o.sha256 = l.sha256, false) AS matches, count(*) AS "references",
  count(*) FILTER (o.sha256 IS NULL) AS unresolved, count(*) FILTER (o.sha256 <> l.sha256) AS rebound
FROM l LEFT JOIN o USING (path) GROUP BY 1""",
    "evidence_paths": r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS bare FROM pages)
SELECT page_id % 10 > 2 AND bare NOT LIKE '%//%' AND bare NOT LIKE '%/' AND length(bare) BETWEEN 1 AND 500 AS path_ok,
  page_id % 7 = 0 AS user_path, count(*) AS pages FROM p GROUP BY 1, 2""",
    "digest_maps": """
SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'empty' WHEN 1 THEN 'repeated character' ELSE 'malformed' END AS problem
FROM pages WHERE page_id % 9 < 3""",
    "header_mismatches": """
WITH j AS (SELECT l_linestatus AS a, o_orderstatus AS b, year(l_shipdate) AS c, year(o_orderdate) AS d
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
SELECT 'status' AS field, count(*) FILTER (a IS DISTINCT FROM b) AS rows FROM j
UNION ALL SELECT 'year', count(*) FILTER (c IS DISTINCT FROM d) FROM j""",
    "lineage_checks": """
SELECT coalesce(quality = 1, false) AS passed, count(*) AS edges
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "table_equality": """
SELECT count(*) FILTER (l_orderkey % 211 = 0 AND l_orderkey % 223 <> 0) AS missing,
  count(*) FILTER (l_orderkey % 223 = 0 AND l_orderkey % 211 <> 0) AS extra FROM lineitem""",
}


def _sql_tree(out: str, rows: str) -> str:
    """CTEs up to ``out`` (name, digest) over ``rows`` (name, p, line): four levels of up to 4,096 digests."""
    parts = [f"{out}0 AS (SELECT name, p, sha256(line) AS h FROM {rows})"]
    for level in range(1, 5):
        below = f"{out}{level - 1}"
        parts.append(
            f"{out}{level} AS (SELECT name, p // 4096 AS p, sha256(string_agg(h, chr(10) ORDER BY p)) AS h "
            f"FROM {below} GROUP BY name, {below}.p // 4096)"
        )
    return ",\n".join([*parts, f"{out} AS (SELECT name, h AS digest FROM {out}4)"])


ORACLES["evidence_chain"] = f"""
WITH RECURSIVE docs AS (SELECT lang, doc_id, text, CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation'
  ELSE 'train' END AS split FROM documents),
rows1 AS (SELECT 'source:' || lang AS name, doc_id AS p, text AS line FROM docs
  UNION ALL SELECT 'split:' || lang || ':' || split, doc_id, text FROM docs
  UNION ALL SELECT 'predictions:' || lang, doc_id, doc_id || ':' || length(text) FROM docs WHERE split = 'test'),
{_sql_tree('made', 'rows1')},
lines AS (SELECT split_part(name, ':', 2) AS lang, name, split_part(name, ':', 1) AS kind,
  CASE WHEN name = 'source:de' THEN sha256(digest) ELSE digest END AS digest FROM made
  WHERE split_part(name, ':', 1) <> 'predictions'),
rows2 AS (SELECT 'manifest:' || lang AS name, CASE WHEN kind = 'source' THEN 0 WHEN name LIKE '%:train' THEN 1
  WHEN name LIKE '%:validation' THEN 2 ELSE 3 END AS p, digest AS line FROM lines),
{_sql_tree('man', 'rows2')},
nodes AS (SELECT * FROM made UNION ALL SELECT * FROM man
  UNION ALL SELECT replace(name, 'predictions', 'report'), digest FROM made WHERE name LIKE 'predictions:%'
  UNION ALL SELECT unnest(['draft:a', 'draft:b', 'note']), repeat('0', 64)),
held AS (SELECT lang, doc_id, t.digest AS test_digest, m.digest AS manifest_digest FROM docs
  JOIN made t ON t.name = 'split:' || lang || ':test' JOIN man m ON m.name = 'manifest:' || lang WHERE split = 'test'),
edges AS (
  SELECT 'manifest:' || lang AS child, 'content:' || name AS role, name AS parent, digest AS declared FROM lines
  UNION SELECT 'predictions:' || lang, 'split', 'split:' || lang || ':test',
    CASE WHEN lang = 'fr' AND doc_id % 20 = 0 THEN sha256(test_digest) ELSE test_digest END FROM held
  UNION SELECT 'predictions:' || lang, 'manifest', 'manifest:' || lang,
    CASE WHEN lang = 'en' AND doc_id % 20 = 0 THEN NULL ELSE manifest_digest END FROM held
  UNION SELECT s.name, 'source', o.name, o.digest FROM made s JOIN made o
    ON s.name LIKE 'split:%' AND o.name = 'source:' || split_part(s.name, ':', 2)
  UNION SELECT replace(name, 'predictions', 'report'), 'predictions',
    name || CASE WHEN name = 'predictions:es' THEN '-old' ELSE '' END, digest FROM made WHERE name LIKE 'predictions:%'
  UNION SELECT 'draft:a', 'draft', 'draft:b', repeat('0', 64) UNION SELECT 'draft:b', 'draft', 'draft:a', repeat('0', 64)),
own AS (SELECT e.*, n.digest AS observed, CASE WHEN declared IS NULL THEN 'no digest' WHEN n.digest IS NULL THEN 'unknown parent'
  WHEN declared <> n.digest THEN 'digest differs'
  WHEN count(*) OVER (PARTITION BY child, role) > 1 THEN 'claims disagree' END AS own
  FROM edges e LEFT JOIN nodes n ON n.name = e.parent),
tainted AS (SELECT child AS name FROM own WHERE own IS NOT NULL
  UNION SELECT o.child FROM own o JOIN tainted t ON o.parent = t.name),
rooted AS (SELECT name FROM nodes WHERE name LIKE 'source:%'
  UNION SELECT o.child FROM own o JOIN rooted r ON o.parent = r.name)
SELECT child, role, parent, declared, observed, CASE WHEN own IS NOT NULL THEN own
  WHEN parent IN (SELECT name FROM tainted) THEN 'rests on a fault'
  WHEN parent NOT IN (SELECT name FROM rooted) THEN 'no root' END AS problem FROM own
UNION ALL SELECT name, NULL, NULL, NULL, NULL, 'claims nothing' FROM nodes
WHERE name NOT LIKE 'source:%' AND name NOT IN (SELECT child FROM edges)"""
