"""MinHash groups against all pairs; the pipeline end to end."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from assaykit.llm import minhash
from assaykit.llm.components import connect


def plain_components(texts, words, percent):
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        size = min(words, len(w)) or 1
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                one, other = sorted((root(a), root(b)))
                label[other] = one
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(rng, base, copies, edits):
    for _ in range(copies):
        words = base[:]
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        yield " ".join(words)


def test_groups_equal_all_pairs(spark):
    rng = random.Random(4)
    texts = {0: None, 1: "", 2: "one", 3: "One", 4: "two words", 5: "  \t", 6: "é a b c d"}
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 200))]
        for text in family(rng, base, 25, max(1, len(base) // 40)):
            texts[len(texts)] = text
    # a chain: neighbours are near, ends are not
    words = [f"c{i}" for i in range(100)]
    for i in range(0, 60, 3):
        texts[len(texts)] = " ".join([f"x{k}" for k in range(i)] + words[i:])
    order = list(texts.items())
    rng.shuffle(order)
    docs = spark.createDataFrame(
        [(i, t, "q", 1) for i, t in order], "doc_id long, text string, digest string, bands int"
    )
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in minhash.near_duplicates(docs, words=4).collect()
    }
    assert got == plain_components(texts, 4, 80)


def test_blocks_find_what_pairs_find(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 1)
    monkeypatch.setattr(minhash, "BLOCK", 700)
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = dict(enumerate(family(rng, base, 40, 2)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, words=4).collect()}
    assert got == {i: c for i, (_, c) in plain_components(texts, 4, 80).items()}


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame(
        [(None, text), (3, text), (3, text), (2, text), (9, "other words here now")],
        "doc_id long, text string",
    )
    rows = minhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [
        (-1, -1), (2, 2), (3, 2), (3, 2), (9, 9),
    ]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_follows_similarity():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for share in (0.2, 0.5, 0.8, 1.0):
        k = int(4000 * 2 * share / (1 + share))
        one = np.concatenate([shared[:k], rng.integers(0, 2**63, 4000 - k, dtype=np.uint64)])
        other = np.concatenate([shared[:k], rng.integers(0, 2**63, 4000 - k, dtype=np.uint64)])
        packed = [minhash.unpacked([minhash.packed(minhash.minima_of(x))]) for x in (one, other)]
        assert abs(minhash.estimate(*packed)[0] - share) < 0.15


def test_components_in_two_steps(spark):
    first = spark.createDataFrame([(5, 4), (9, 8), (4, 3)], "a long, b long")
    labels = connect(first)
    assert {tuple(r) for r in labels.collect()} == {(5, 3), (4, 3), (3, 3), (9, 8), (8, 8)}
    more = spark.createDataFrame([(9, 5), (20, 21)], "a long, b long")
    got = {tuple(r) for r in connect(more, labels).collect()}
    assert got == {(i, 3) for i in (3, 4, 5, 8, 9)} | {(20, 20), (21, 20)}


def test_long_path_is_one_component(spark):
    n = 300
    links = spark.range(n - 1).select(
        F.pmod(F.col("id") * 7, F.lit(n)).alias("a"), F.pmod((F.col("id") + 1) * 7, F.lit(n)).alias("b")
    )
    assert {r["component"] for r in connect(links).collect()} == {0}


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.run(spark, folder)
    ids = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**7, None, "en", "s", 3)], docs.schema)
    docs = odd.withColumn("row", F.lit(1)).withColumn("text", F.col("text"))
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, folder).count() == 2
        assert stage(spark, docs.limit(0), folder).count() == 0


def tasks_of(spark, group):
    """Tasks of the stages that ran under a job group."""
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)


def test_few_links_take_few_tasks(spark):
    """Tables of a few rows are not dealt out over all partitions in every turn."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long").coalesce(1)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 60)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.sparkContext.setJobGroup("few-links", "few links")
        labels = connect(links)
        assert {r["component"] for r in labels.collect()} == {0}
        assert 0 < tasks_of(spark, "few-links") < 180
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
