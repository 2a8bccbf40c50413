"""Registered split queries: counts, splits, balance, coverage, manifests, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.catalog import derived as d
from assaykit.catalog.corpus import SQL_VIOLATIONS
from assaykit.functions import digests
from assaykit.functions import text as tx
from assaykit.operators import allocation, splitting
from assaykit.operators import distributions as dist
from assaykit.operators.duplicates import shared_across
from assaykit.operators.ranking import rank_by_digest
from assaykit.plans import corpus as plan
from assaykit.session import durable
from assaykit.sources import grid
from assaykit.tables import read_table

GRID_DIMENSIONS = ["lang", "quality", "toxic"]


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").join(
        read_table(spark, folder, "labels"), "doc_id"
    )


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled(spark, folder)
    return dist.label_distribution(
        rows, {name: F.col(name) for name in GRID_DIMENSIONS}, ["source"]
    )


def order_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Label counts of a large table."""
    rows = read_table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return dist.label_distribution(
        rows, {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}, ["year"]
    )


def grid_balance(spark: SparkSession, folder: str) -> DataFrame:
    return dist.grid_balance(_labelled(spark, folder), GRID_DIMENSIONS, "source")


def grid_summary(spark: SparkSession, folder: str) -> DataFrame:
    return dist.balance_summary(grid_balance(spark, folder))


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return allocation.split_counts(read_table(spark, folder, "documents"), "lang")


def split_counts_small(spark: SparkSession, folder: str) -> DataFrame:
    """Many small strata: rounding ties and splits that would stay empty."""
    docs = read_table(spark, folder, "documents")
    rows = docs.select(F.concat_ws("/", "lang", "source").alias("stratum"))
    return allocation.split_counts(rows, "stratum", {"train": 0.9, "validation": 0.05, "test": 0.05})


def split_simple(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.simple_split(read_table(spark, folder, "documents"), "doc_id", "lang")


def holdout_coverage(spark: SparkSession, folder: str) -> DataFrame:
    placed = split_simple(spark, folder).select(F.col("id").alias("doc_id"), "split")
    t = d.tickets(spark, folder).select("doc_id", *fv.LABEL_DIMENSIONS)
    rows = t.join(placed, "doc_id")
    return dist.holdout_coverage(rows, "split", fv.LABEL_DIMENSIONS)


def split_leakage(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints that a split by id leaves on both sides."""
    placed = split_simple(spark, folder).select(F.col("id").alias("doc_id"), "split")
    docs = tx.with_fingerprint(read_table(spark, folder, "documents"), F.col("text"))
    return shared_across(docs.select("doc_id", "fingerprint").join(placed, "doc_id"), "fingerprint", "split")


def split_balanced(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.stratified_split(d.tickets(spark, folder), "doc_id", "category")


def split_balanced_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per category and split of the balanced split."""
    placed = split_balanced(spark, folder)
    t = d.tickets(spark, folder).select(F.col("doc_id").cast("string").alias("id"), "category")
    return placed.join(t, "id").groupBy("category", "split").agg(F.count(F.lit(1)).alias("rows"))


def split_balanced_priorities(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the holdouts of the balanced split have even priorities and all labels."""
    placed = split_balanced(spark, folder)
    t = d.tickets(spark, folder).select(
        F.col("doc_id").cast("string").alias("id"), *fv.LABEL_DIMENSIONS
    )
    return dist.holdout_coverage(placed.join(t, "id"), "split", fv.LABEL_DIMENSIONS).select(
        "split", "dimension", "feasible", "missing_labels", "passed"
    )


def split_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.candidate_label_counts(d.tickets(spark, folder), "doc_id", "category").select(
        "stratum", "candidate", "p", "s", "rows"
    )


def manifest_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Tree digest of the documents of each language, in id order."""
    docs = read_table(spark, folder, "documents").withColumn("position", F.col("doc_id"))
    return digests.tree_digest(docs, ["lang"], "position", F.col("text"), fan_out=64, levels=3)


def order_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every order in the seeded order of its priority."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority",
        tx.order_key(42, F.col("o_orderpriority"), F.col("o_orderkey")).alias("key"),
    )
    return rank_by_digest(orders, ["o_orderpriority"], "key", "place").select(
        "o_orderkey", "o_orderpriority", "place"
    )


def run_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Run id of every order, taking its date as the time and its labels as the configuration."""
    orders = read_table(spark, folder, "orders")
    config = digests.canonical_digest(
        {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}
    )
    return orders.select("o_orderkey", digests.run_id(F.col("o_orderdate"), config).alias("run_id"))


def prepare_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Label manifest of the prepared corpus: validated, split, projected and counted.

    Categories are listed per split; which rows carry the other labels is up to the balanced
    search, so those are listed over all splits.
    """
    checked = plan.validate(d.corpus_lines(spark, folder), d.SYSTEM_TEXT)
    made = plan.prepare(durable(checked.clean))
    split = F.when(F.col("dimension") == "category", F.col("split")).otherwise("all")
    return made.manifest_labels.groupBy(split.alias("split"), "dimension", "label").agg(
        F.sum("rows").alias("rows")
    )


def verify_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Problems found in a published copy with changed, lost, added and moved rows."""
    placed = split_simple(spark, folder)
    t = d.tickets(spark, folder)
    base = durable(
        placed.join(t.withColumnRenamed("doc_id", "id"), ["id"]).select(
            "split", "position", F.col("id").cast("string").alias("id"),
            F.sha2("text", 256).alias("line"), *fv.LABEL_DIMENSIONS
        )
    )
    number = F.col("id").cast("long")
    published = (
        base.where(number % 97 != 0)
        .withColumn("line", F.when(number % 89 == 0, F.concat("line", F.lit(" "))).otherwise(F.col("line")))
        .withColumn("id", F.when(number % 83 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    )
    extra = base.where(number % 101 == 0).withColumn("position", F.col("position") + 10_000_000)
    declared = digests.tree_digest(base, ["split"], "position", F.col("line")).withColumn(
        "digest", F.when(F.col("split") == "test", F.lit("0")).otherwise(F.col("digest"))
    )
    labels = dist.label_distribution(
        base, {n: F.col(n) for n in fv.LABEL_DIMENSIONS}, ["split"]
    ).withColumn("rows", F.col("rows") + (F.col("label") == "bug").cast("long"))
    return plan.verify(base, published.unionByName(extra), declared, labels)


def manifest_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory problems of a manifest with a wrong count, an overlap and a repeated id."""
    placed = split_simple(spark, folder).select("split", F.col("id").cast("string").alias("id"))
    inventory = placed.unionByName(
        placed.where((F.col("split") == "test") & (F.col("id").cast("long") % 50 == 0))
    ).unionByName(
        placed.where((F.col("split") == "test") & (F.col("id").cast("long") % 70 == 0)).withColumn(
            "split", F.lit("train")
        )
    )
    declared = placed.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return dist.split_inventory_problems(inventory, declared, 7)


def grid_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Label grid over parts as scenarios: one record per part, priority and sentiment."""
    parts = read_table(spark, folder, "part")
    scenarios = parts.select(
        d.label(fv.CATEGORIES, F.col("p_partkey") % 7).alias("category"),
        F.col("p_partkey").alias("variant"),
        F.concat_ws(" ", F.lit("The"), "p_name", F.lit("[ITEM_ID] of"), "p_brand", F.lit("fails.")).alias("issue"),
        F.col("p_name").alias("subject"),
        F.lit("review_item").alias("next_action"),
        F.array(F.lit("[ITEM_ID]")).alias("placeholders"),
    )
    texts = grid.GridTexts()
    made = grid.label_grid(scenarios, texts)
    return made.select(
        "id", "expected.category", "expected.priority", "expected.sentiment", "expected.response",
        F.get("messages", F.lit(1))["content"].alias("user_text"),
    )


QUERIES = {
    "label_distribution": label_distribution,
    "order_distribution": order_distribution,
    "grid_balance": grid_balance,
    "grid_summary": grid_summary,
    "split_counts": split_counts,
    "split_counts_small": split_counts_small,
    "split_simple": split_simple,
    "holdout_coverage": holdout_coverage,
    "split_leakage": split_leakage,
    "split_balanced": split_balanced,
    "split_balanced_counts": split_balanced_counts,
    "split_balanced_priorities": split_balanced_priorities,
    "split_candidates": split_candidates,
    "manifest_digest": manifest_digest,
    "order_keys": order_keys,
    "run_ids": run_ids,
    "prepare_corpus": prepare_corpus,
    "verify_splits": verify_splits,
    "manifest_problems": manifest_problems,
    "grid_corpus": grid_corpus,
}


def sql_counts(rows: str, stratum: str, fractions=(0.75, 0.125, 0.125)) -> str:
    """CTEs ``sizes``..``counts``: largest remainder, then up to three moves to empty splits."""
    t, v, e = fractions
    return f"""
sizes AS (SELECT {stratum} AS stratum, count(*) AS n FROM {rows} GROUP BY 1),
parts AS (SELECT stratum, n, i, n * f AS raw, floor(n * f) AS whole FROM sizes,
  (VALUES (0, {t}::DOUBLE), (1, {v}::DOUBLE), (2, {e}::DOUBLE)) AS fr(i, f)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY raw - whole DESC, i) AS k,
  n - sum(whole) OVER (PARTITION BY stratum) AS rest FROM parts),
raw_counts AS (SELECT stratum, n,
  CAST(max(CASE WHEN i = 0 THEN whole + CASE WHEN k <= rest THEN 1 ELSE 0 END END) AS BIGINT) AS a,
  CAST(max(CASE WHEN i = 1 THEN whole + CASE WHEN k <= rest THEN 1 ELSE 0 END END) AS BIGINT) AS b,
  CAST(max(CASE WHEN i = 2 THEN whole + CASE WHEN k <= rest THEN 1 ELSE 0 END END) AS BIGINT) AS c
  FROM ranked GROUP BY stratum, n),
step1 AS (SELECT stratum, n,
  a + CASE WHEN n >= 3 AND a = 0 AND greatest(b, c) > 1 THEN 1 ELSE 0 END AS a,
  b - CASE WHEN n >= 3 AND a = 0 AND greatest(b, c) > 1 AND b >= c THEN 1 ELSE 0 END AS b,
  c - CASE WHEN n >= 3 AND a = 0 AND greatest(b, c) > 1 AND b < c THEN 1 ELSE 0 END AS c FROM raw_counts),
step2 AS (SELECT stratum, n,
  a - CASE WHEN n >= 3 AND b = 0 AND greatest(a, c) > 1 AND a >= c THEN 1 ELSE 0 END AS a,
  b + CASE WHEN n >= 3 AND b = 0 AND greatest(a, c) > 1 THEN 1 ELSE 0 END AS b,
  c - CASE WHEN n >= 3 AND b = 0 AND greatest(a, c) > 1 AND a < c THEN 1 ELSE 0 END AS c FROM step1),
counts AS (SELECT stratum, n AS size,
  a - CASE WHEN n >= 3 AND c = 0 AND greatest(a, b) > 1 AND a >= b THEN 1 ELSE 0 END AS train,
  b - CASE WHEN n >= 3 AND c = 0 AND greatest(a, b) > 1 AND a < b THEN 1 ELSE 0 END AS validation,
  c + CASE WHEN n >= 3 AND c = 0 AND greatest(a, b) > 1 THEN 1 ELSE 0 END AS test FROM step2)"""


_SIMPLE = f"""{sql_counts('documents', 'lang')},
strata AS (SELECT doc_id AS id, lang AS stratum,
  row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || lang || ':' || doc_id)) - 1 AS r FROM documents),
placed AS (SELECT id, s.stratum, CASE WHEN r < validation THEN 'validation'
  WHEN r < validation + test THEN 'test' ELSE 'train' END AS split FROM strata s JOIN counts USING (stratum)),
simple AS (SELECT id, stratum, split, row_number() OVER (PARTITION BY split
  ORDER BY sha256('42:split:' || split || ':' || id)) - 1 AS position FROM placed)"""

_VARIANT_ROWS = f"""
{d.SQL_TICKETS},
{sql_counts('tickets', 'category')},
base AS (SELECT CAST(doc_id AS VARCHAR) AS id, category AS stratum,
  list_position({d.SQL_LABELS['priority']}, priority) - 1 AS p,
  list_position({d.SQL_LABELS['sentiment']}, sentiment) - 1 AS s,
  row_number() OVER (PARTITION BY category ORDER BY sha256('42:validation:' || category || ':' || doc_id)) AS idx
  FROM tickets),
modes AS (SELECT * FROM (VALUES (0, 'joint'), (1, 'priority'), (2, 'sentiment')) m(mi, mode), range(32) r(v)),
crossed AS (SELECT b.*, mi, mode, v, CASE mode WHEN 'joint' THEN p || ':' || s WHEN 'priority' THEN p || ''
  ELSE s || '' END AS bucket FROM base b, modes),
seated AS (SELECT *, row_number() OVER (PARTITION BY stratum, mode, v, bucket ORDER BY idx) - 1 AS i,
  count(*) OVER (PARTITION BY stratum, mode, v, bucket) AS m FROM crossed),
turned AS (SELECT *, (i - v % m + m) % m AS round,
  sha256('42:validation:' || stratum || ':bounded:' || mode || ':' || v || ':' || bucket) AS bucket_key FROM seated),
drawn AS (SELECT *, row_number() OVER (PARTITION BY stratum, mode, v ORDER BY round, bucket_key) AS k FROM turned)"""

def _sql_holdout(split: str, rows: str) -> str:
    """CTEs ``<split>_base``..``<split>_held``: the holdout chosen stratum by stratum.

    Every candidate is drawn row by row, strata of at most 128 subsets have all of them, and ties
    are decided by the whole list of digests. That the choice keeps all labels is checked at the
    end (else another search would follow).
    """
    x, first, second = split, len(fv.PRIORITIES), len(fv.SENTIMENTS)
    strata = sorted(fv.CATEGORIES)

    def counts(column: str, n: int) -> str:
        return "[" + ", ".join(f"count(*) FILTER ({column} = {i})" for i in range(n)) + "]"

    steps = []
    for step, stratum in enumerate(strata, 1):
        steps.append(f"""
{x}_{step} AS (SELECT candidate, f, s FROM (SELECT c.candidate, tie,
    list_transform(range(1, {first + 1}), lambda i: g.f[i] + c.f[i]) AS f,
    list_transform(range(1, {second + 1}), lambda i: g.s[i] + c.s[i]) AS s
  FROM {x}_{step - 1} g, {x}_cand c WHERE stratum = '{stratum}')
  ORDER BY len(list_filter(s, lambda n: n = 0)), len(list_filter(f, lambda n: n = 0)), list_max(f) - list_min(f),
    list_sum(list_transform(f, lambda n: n * n)), list_max(s) - list_min(s), tie, candidate LIMIT 1)""")
    chosen = " UNION ALL ".join(
        f"SELECT '{stratum}' AS stratum, candidate FROM {x}_{step}" for step, stratum in enumerate(strata, 1)
    )
    last = f"{x}_{len(strata)}"
    return f"""
{x}_base AS (SELECT *, row_number() OVER (PARTITION BY stratum
  ORDER BY sha256('42:{split}:' || stratum || ':' || id)) AS idx FROM {rows}),
{x}_crossed AS (SELECT b.*, mi, mode, v, CASE mode WHEN 'joint' THEN p || ':' || s WHEN 'priority' THEN p || ''
  ELSE s || '' END AS bucket FROM {x}_base b, modes),
{x}_seated AS (SELECT *, row_number() OVER (PARTITION BY stratum, mode, v, bucket ORDER BY idx) - 1 AS i,
  count(*) OVER (PARTITION BY stratum, mode, v, bucket) AS m FROM {x}_crossed),
{x}_turned AS (SELECT *, (i - v % m + m) % m AS round,
  sha256('42:{split}:' || stratum || ':bounded:' || mode || ':' || v || ':' || bucket) AS bucket_key FROM {x}_seated),
{x}_drawn AS (SELECT *, row_number() OVER (PARTITION BY stratum, mode, v ORDER BY round, bucket_key) AS k
  FROM {x}_turned),
{x}_sizes AS (SELECT stratum, any_value({split}) AS k, count(*) AS n, least(any_value({split}), count(*) - any_value({split})) AS e
  FROM {x}_base JOIN counts USING (stratum) GROUP BY stratum),
{x}_few AS (SELECT * FROM {x}_sizes WHERE (e = 1 AND n <= 128) OR (e = 2 AND n <= 16) OR (e = 3 AND n <= 10) OR (e = 4 AND n <= 9)),
{x}_subsets AS (SELECT stratum, k, CAST([] AS BIGINT[]) AS chosen, 0::BIGINT AS last FROM {x}_few
  UNION ALL SELECT o.stratum, o.k, list_append(o.chosen, b.idx), b.idx FROM {x}_subsets o JOIN {x}_base b
    ON b.stratum = o.stratum AND b.idx > o.last WHERE len(o.chosen) < o.k),
{x}_numbered AS (SELECT stratum, row_number() OVER () AS candidate, chosen FROM {x}_subsets WHERE len(chosen) = k),
{x}_picked AS (SELECT stratum, 1 + mi * 32 + v AS candidate, id, idx, p, s FROM {x}_drawn JOIN counts USING (stratum)
  WHERE k <= {split} AND stratum NOT IN (SELECT stratum FROM {x}_few)
  UNION ALL SELECT stratum, 0, id, idx, p, s FROM {x}_base JOIN counts USING (stratum)
  WHERE idx <= {split} AND stratum NOT IN (SELECT stratum FROM {x}_few)
  UNION ALL SELECT b.stratum, candidate, id, idx, p, s FROM {x}_numbered m JOIN {x}_base b
    ON b.stratum = m.stratum AND list_contains(chosen, idx)),
{x}_slots AS (SELECT *, row_number() OVER (PARTITION BY stratum, candidate ORDER BY idx) - 1 AS slot FROM {x}_picked),
{x}_cand AS (SELECT stratum, candidate, {counts("p", first)} AS f, {counts("s", second)} AS s,
  list(sha256('42:{split}:' || stratum || ':choice:' || slot || ':' || id) ORDER BY slot) AS tie
  FROM {x}_slots GROUP BY 1, 2),
{x}_0 AS (SELECT list_transform(range({first}), lambda i: 0) AS f, list_transform(range({second}), lambda i: 0) AS s),
{",".join(steps)},
{x}_sure AS (SELECT CASE WHEN list_min(f) > 0 AND list_min(s) > 0 AND list_max(f) - list_min(f) <= 1 THEN true
  ELSE error('the choice of {split} loses a label') END AS ok FROM {last}),
{x}_held AS (SELECT id FROM {x}_picked JOIN ({chosen}) USING (stratum, candidate), {x}_sure WHERE ok)"""


_BALANCED = f"""
{d.SQL_TICKETS},
{sql_counts('tickets', 'category')},
modes AS (SELECT * FROM (VALUES (0, 'joint'), (1, 'priority'), (2, 'sentiment')) m(mi, mode), range(32) r(v)),
source_rows AS (SELECT CAST(doc_id AS VARCHAR) AS id, category AS stratum,
  list_position({d.SQL_LABELS['priority']}, priority) - 1 AS p,
  list_position({d.SQL_LABELS['sentiment']}, sentiment) - 1 AS s FROM tickets),
{_sql_holdout('validation', 'source_rows')},
left_rows AS (SELECT * FROM source_rows ANTI JOIN validation_held USING (id)),
{_sql_holdout('test', 'left_rows')},
balanced AS (SELECT id, stratum, CASE WHEN id IN (SELECT id FROM validation_held) THEN 'validation'
  WHEN id IN (SELECT id FROM test_held) THEN 'test' ELSE 'train' END AS split FROM source_rows)"""

ORACLES = {
    "split_balanced": f"""WITH RECURSIVE {_BALANCED}
SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY sha256('42:split:' || split || ':' || id)) - 1 AS position
FROM balanced""",
    "label_distribution": """
WITH j AS (SELECT * FROM documents JOIN labels USING (doc_id))
SELECT source, 'lang' AS dimension, lang AS label, count(*) AS rows FROM j GROUP BY 1, 3
UNION ALL SELECT source, 'quality', CAST(quality AS VARCHAR), count(*) FROM j GROUP BY 1, 3
UNION ALL SELECT source, 'toxic', CAST(toxic AS VARCHAR), count(*) FROM j GROUP BY 1, 3""",
    "order_distribution": """
SELECT year(o_orderdate) AS year, 'status' AS dimension, o_orderstatus AS label, count(*) AS rows
FROM orders GROUP BY 1, 3
UNION ALL SELECT year(o_orderdate), 'priority', o_orderpriority, count(*) FROM orders GROUP BY 1, 3""",
    "grid_balance": """
WITH j AS (SELECT * FROM documents JOIN labels USING (doc_id)),
g AS (SELECT lang, quality, toxic, grouping(lang, quality, toxic) AS gid, count(*) AS rows,
      count(DISTINCT source) AS variants
      FROM j GROUP BY GROUPING SETS ((lang, quality, toxic), (lang), (quality), (toxic)))
SELECT CASE gid WHEN 0 THEN 'cell' WHEN 3 THEN 'lang' WHEN 5 THEN 'quality' ELSE 'toxic' END AS level,
  concat_ws('/', lang, CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR)) AS label, rows, variants FROM g""",
    "grid_summary": """
WITH j AS (SELECT * FROM documents JOIN labels USING (doc_id)),
g AS (SELECT grouping(lang, quality, toxic) AS gid, count(*) AS rows, count(DISTINCT source) AS variants
      FROM j GROUP BY GROUPING SETS ((lang, quality, toxic), (lang), (quality), (toxic)))
SELECT CASE gid WHEN 0 THEN 'cell' WHEN 3 THEN 'lang' WHEN 5 THEN 'quality' ELSE 'toxic' END AS level,
  count(*) AS labels, min(rows) AS min_rows, max(rows) AS max_rows, min(variants) AS min_variants,
  max(variants) AS max_variants FROM g GROUP BY 1""",
    "split_counts": f"""WITH {sql_counts('documents', 'lang')}
SELECT stratum AS lang, size, train, validation, test FROM counts""",
    "split_counts_small": f"""WITH {sql_counts('documents', "concat_ws('/', lang, source)", (0.9, 0.05, 0.05))}
SELECT stratum, size, train, validation, test FROM counts""",
    "split_simple": f"WITH {_SIMPLE} SELECT * FROM simple",
    "holdout_coverage": f"""WITH {d.SQL_TICKETS}, {_SIMPLE},
lab AS (SELECT split, x.dimension, x.label FROM (
  SELECT split, unnest([{{'dimension': 'category', 'label': category}},
    {{'dimension': 'priority', 'label': priority}}, {{'dimension': 'sentiment', 'label': sentiment}}]) AS x
  FROM simple JOIN tickets ON id = doc_id)),
known AS (SELECT 'category' AS dimension, unnest({d.SQL_LABELS['category']}) AS label
  UNION ALL SELECT 'priority', unnest({d.SQL_LABELS['priority']})
  UNION ALL SELECT 'sentiment', unnest({d.SQL_LABELS['sentiment']})),
per AS (SELECT k.dimension, k.label, count(l.label) AS src,
  count(*) FILTER (l.split = 'validation') AS v, count(*) FILTER (l.split = 'test') AS t
  FROM known k LEFT JOIN lab l ON k.dimension = l.dimension AND k.label = l.label GROUP BY 1, 2),
tot AS (SELECT dimension, min(src) >= 2 AND sum(v) >= count(*) AND sum(t) >= count(*) AS feasible,
  count(*) FILTER (v = 0) AS mv, count(*) FILTER (t = 0) AS mt, max(v) - min(v) AS rv, max(t) - min(t) AS rt
  FROM per GROUP BY 1),
un AS (SELECT 'validation' AS split, dimension, feasible, mv AS missing_labels, rv AS label_range FROM tot
  UNION ALL SELECT 'test', dimension, feasible, mt, rt FROM tot)
SELECT *, NOT feasible OR (missing_labels = 0 AND (dimension <> 'priority' OR label_range <= 1)) AS passed FROM un""",
    "split_leakage": f"""WITH {_SIMPLE}
SELECT {d.sql_fingerprint('text')} AS fingerprint, count(DISTINCT split) AS sets, count(*) AS rows,
  min(split) AS first_set, max(split) AS last_set FROM simple JOIN documents ON id = doc_id
GROUP BY 1 HAVING count(DISTINCT split) > 1""",
    "split_balanced_counts": f"""WITH {d.SQL_TICKETS}, {sql_counts('tickets', 'category')}
SELECT stratum AS category, unnest(['train', 'validation', 'test']) AS split,
  unnest([train, validation, test]) AS rows FROM counts""",
    "split_balanced_priorities": """
SELECT s.split, dm.dimension, true AS feasible, 0 AS missing_labels, true AS passed
FROM (VALUES ('validation'), ('test')) s(split),
     (SELECT DISTINCT unnest(['category', 'priority', 'sentiment']) AS dimension FROM documents) dm""",
    "split_candidates": f"""WITH {_VARIANT_ROWS},
many AS (SELECT stratum, validation FROM (SELECT *, least(validation, size - validation) AS e FROM counts)
  WHERE (e = 1 AND size > 128) OR (e = 2 AND size > 16) OR (e = 3 AND size > 10) OR (e = 4 AND size > 9) OR e > 4),
picked AS (SELECT stratum, 1 + mi * 32 + v AS candidate, p, s FROM drawn JOIN many USING (stratum)
  WHERE k <= validation
  UNION ALL SELECT stratum, 0, p, s FROM base JOIN many USING (stratum) WHERE idx <= validation)
SELECT stratum, candidate, p, s, count(*) AS rows FROM picked GROUP BY ALL""",
    "manifest_digest": """
WITH l0 AS (SELECT lang, doc_id AS p, sha256(text) AS h FROM documents),
l1 AS (SELECT lang, p // 64 AS p, sha256(string_agg(h, chr(10) ORDER BY p)) AS h FROM l0 GROUP BY lang, l0.p // 64),
l2 AS (SELECT lang, p // 64 AS p, sha256(string_agg(h, chr(10) ORDER BY p)) AS h FROM l1 GROUP BY lang, l1.p // 64),
l3 AS (SELECT lang, p // 64 AS p, sha256(string_agg(h, chr(10) ORDER BY p)) AS h FROM l2 GROUP BY lang, l2.p // 64)
SELECT l3.lang, n AS lines, h AS digest FROM l3 JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) USING (lang)""",
    "order_keys": """
SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY sha256('42:' || o_orderpriority || ':' || o_orderkey)) - 1 AS place FROM orders""",
    "prepare_corpus": f"""WITH {SQL_VIOLATIONS},
clean AS (SELECT * FROM lined WHERE line_no NOT IN (SELECT line_no FROM found)),
{sql_counts('clean', 'category')},
c AS (SELECT stratum, unnest(['train', 'validation', 'test']) AS split, unnest([train, validation, test]) AS rows FROM counts)
SELECT split, 'category' AS dimension, stratum AS label, rows FROM c WHERE rows > 0
UNION ALL SELECT 'all', 'priority', priority, count(*) FROM clean GROUP BY 3
UNION ALL SELECT 'all', 'sentiment', sentiment, count(*) FROM clean GROUP BY 3""",
    "run_ids": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%S.%fZ') || '-' || substr(sha256('{"priority":"' || o_orderpriority
  || '","status":"' || o_orderstatus || '"}'), 1, 12) AS run_id FROM orders""",
    "verify_splits": f"""WITH {d.SQL_TICKETS}, {_SIMPLE},
rows_bad AS (
  SELECT CASE WHEN id % 97 = 0 THEN 'row missing' WHEN id % 83 = 0 THEN 'ordered ids differ'
              WHEN id % 89 = 0 THEN 'bytes differ' END AS "check", split FROM simple
  UNION ALL SELECT 'row unexpected', split FROM simple WHERE id % 101 = 0
  UNION ALL SELECT 'declared digest differs', 'test' WHERE EXISTS (SELECT 1 FROM simple WHERE split = 'test')
  UNION ALL SELECT DISTINCT 'label distribution differs', split FROM simple JOIN tickets ON id = doc_id
    WHERE category = 'bug')
SELECT "check", split, count(*) AS cases FROM rows_bad WHERE "check" IS NOT NULL GROUP BY 1, 2""",
    "manifest_problems": f"""WITH {_SIMPLE},
inv AS (SELECT split, id FROM simple UNION ALL SELECT split, id FROM simple WHERE split = 'test' AND id % 50 = 0
  UNION ALL SELECT 'train', id FROM simple WHERE split = 'test' AND id % 70 = 0),
pairs AS (SELECT id, split, count(*) AS n FROM inv GROUP BY 1, 2),
per AS (SELECT id, max(n) AS most, count(*) AS sets, min(split) AS split FROM pairs GROUP BY 1),
bad AS (SELECT s.split, 'count differs' AS problem
    FROM (SELECT split, count(*) AS n FROM simple GROUP BY 1) s JOIN (SELECT split, count(*) AS n FROM inv GROUP BY 1) i
    USING (split) WHERE s.n <> i.n
  UNION ALL SELECT split, 'repeated id' FROM per WHERE most > 1
  UNION ALL SELECT split, 'id in two splits' FROM per WHERE sets > 1
  UNION ALL SELECT '', 'total differs' WHERE (SELECT count(*) FROM simple) <> 7)
SELECT split, problem, count(*) AS cases FROM bad GROUP BY 1, 2""",
}


def _grid_sql() -> str:
    texts = grid.GridTexts()

    def pick(table: dict[str, str], key: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
        return f"CASE {key} {cases} END"

    before, after = texts.response.split("%s")
    return f"""
WITH sc AS (SELECT {d.SQL_LABELS['category']}[CAST(p_partkey % 7 AS INTEGER) + 1] AS category, p_partkey AS variant,
  'The ' || p_name || ' [ITEM_ID] of ' || p_brand || ' fails.' AS issue, p_name AS subject FROM part),
g AS (SELECT sc.*, p.priority, s.sentiment FROM sc,
  (SELECT unnest({d.SQL_LABELS['priority']}) AS priority) p, (SELECT unnest({d.SQL_LABELS['sentiment']}) AS sentiment) s)
SELECT printf('{texts.id_prefix}-%s-%s-%s-%02d', {pick(fv.CATEGORY_CODES, 'category')},
    {pick(fv.PRIORITY_CODES, 'priority')}, {pick(fv.SENTIMENT_CODES, 'sentiment')}, variant) AS id,
  category, priority, sentiment, '{before}' || subject || '{after}' AS response,
  {pick(texts.sentiment_cues, 'sentiment')} || ' ' || issue || ' ' || {pick(texts.priority_cues, 'priority')} AS user_text
FROM g"""


ORACLES["grid_corpus"] = _grid_sql()
