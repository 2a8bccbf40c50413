"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaykit.functions.stages import with_computed
from assaykit.llm import (
    bin_slack,
    decontamination,
    divergence,
    html_paths,
    language_id,
    licenses,
    minhash,
    oracles,
    packing,
    periodic,
    quality,
    secret_scan,
    url_filters,
    warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark, folder):
    judged = quality.judge(quality.measure(_table(spark, folder, "documents")))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


def vocabulary() -> str:
    """Path of the public byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark, folder):
    pieces = packing.pack(_table(spark, folder, "documents"), vocabulary())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_html_extraction(spark, folder):
    found = html_paths.extract(_table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_decontamination(spark, folder):
    return decontamination.find(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op5_license_scan(spark, folder):
    return licenses.scan(_table(spark, folder, "documents"))


def op6_language_id(spark, folder):
    documents = _table(spark, folder, "documents")
    found = language_id.identify(documents, language_id.train(documents))
    held_out = F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_minhash(spark, folder):
    found = minhash.near_duplicates(_table(spark, folder, "documents"), words=4)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: Rules of the query.
URL_LISTS = url_filters.Lists(
    allow=("com/", "www.example.com/en/"),
    block=("example.com/en/", "net/es/", "net/fr/"),
    more=tuple(
        f"{name}.example.{domain}/"
        for name in "spam-farm free-bets ads-track casino-win adult-x cheap-pills".split()
        for domain in ("com", "net", "org")
    ),
)


def op8_url_filters(spark, folder):
    return url_filters.judge(_table(spark, folder, "pages"), URL_LISTS)


def op9_secret_scan(spark, folder):
    found = secret_scan.scan(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in secret_scan.BASE_RULES]))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op10_warc(spark, folder):
    manifest, place = warc.archive(_table(spark, folder, "pages"))
    return warc.read(spark, manifest, place).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _with_repetition(documents: DataFrame) -> DataFrame:
    """doc_id and text; one document in ten, by its id, repeats a stretch of words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    chosen = F.col("h") % 10 == 0
    words = F.filter(F.split("text", periodic.BETWEEN), lambda w: w != "")
    rows = with_computed(rows, {"words": F.when(chosen, words)})
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
        "CAST((n - a - 1) div p + 1 AS INT))), 1, n - a)), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, folder):
    found = periodic.find(_with_repetition(_table(spark, folder, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")
    listed = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_bin_slack(spark, folder):
    pieces = bin_slack.pack(_table(spark, folder, "documents"), vocabulary())
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op13_source_divergence(spark, folder):
    return divergence.audit(_table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_packing,
        op3_html_extraction,
        op4_decontamination,
        op5_license_scan,
        op6_language_id,
        op7_minhash,
        op8_url_filters,
        op9_secret_scan,
        op10_warc,
        op11_periodic_runs,
        op12_bin_slack,
        op13_source_divergence,
    )
}
ORACLES = {
    "op1_quality_rules": oracles.quality_rules(),
    "op4_decontamination": oracles.decontaminated(),
    "op7_minhash": oracles.near_duplicates(),
    "op8_url_filters": oracles.url_filters(URL_LISTS),
    "op9_secret_scan": oracles.secrets(),
    "op10_warc": oracles.archived(),
    "op11_periodic_runs": oracles.periodic_runs(),
    "op13_source_divergence": oracles.source_divergence(),
}
