"""Documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, the next one's docs. All but the
last keep the columns of documents. Rows with a null doc_id pass the stages that decide by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.llm import decontamination, minhash, packing, quality, secret_scan
from assaykit.llm.queries import vocabulary
from assaykit.session import configure, durable, small_side

#: MinHash, fuzzy grouping and tokenisation cannot be put into SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    groups = minhash.near_duplicates(docs)
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(small_side(durable(copies)), "doc_id", "left_anti").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.find(docs, benchmark).select("doc_id").distinct()
    return docs.join(small_side(durable(leaks)), "doc_id", "left_anti").select(docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; n_chars follows the text."""
    found = secret_scan.scan(docs, keep_rows=True)
    text = secret_scan.redacted(F.col("text"), F.col("secret_spans"))
    changed = F.size("secret_spans") > 0
    columns = {"text": text}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        columns["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(columns).select(docs.columns)


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, related documents side by side."""
    return packing.pack(docs, vocabulary()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_redaction", secret_redaction),
    ("retrieval_packing", retrieval_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage keeps is written before the next reads it."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = durable(docs)
    return docs
