"""Bin slack packing: every id once, few sequences, combinations as full as they can be."""

from __future__ import annotations

import random
import zlib
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer

from assaykit.llm import bin_slack, queries
from assaykit.llm.queries import vocabulary


@pytest.mark.parametrize("seed", range(6))
def test_fullest_combination_equals_trying_all(seed):
    rng = random.Random(seed)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 30), rng.randrange(1, 6)))
        available = [(k, rng.randrange(1, 4)) for k in lengths]
        room = rng.randrange(1, 60)
        best = max(
            t for used in product(*(range(n + 1) for _, n in available))
            if (t := sum(k * u for (k, _), u in zip(available, used, strict=True))) <= room
        )
        taken = bin_slack.fullest(available, room)
        assert sum(k * n for k, n in taken) == best
        assert all(0 < n <= dict(available)[k] for k, n in taken) and len(dict(taken)) == len(taken)


def sequences_one_by_one(counts, window):
    """The same rule, a bin at a time."""
    left, bins = dict(counts), 0
    while any(left.values()):
        top = max(k for k, n in left.items() if n)
        left[top] -= 1
        for k, n in bin_slack.fullest(sorted((k, n) for k, n in left.items() if n), window - top):
            left[k] -= n
        bins += 1
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_plan_takes_every_piece_and_repeats_fairly(seed):
    rng = random.Random(seed)
    window = 64
    counts = {k: rng.randrange(0, 40) for k in rng.sample(range(1, window + 1), 20)}
    for first in (True, False):
        plan = bin_slack.plan(counts, window, first)
        assert all(sum(k * n for k, n in takes) <= window for takes in plan.takes)
        used = dict.fromkeys(counts, 0)
        for takes, bins in zip(plan.takes, plan.bins, strict=True):
            for k, n in takes:
                used[k] += n * bins
        assert used == counts
    assert bin_slack.plan(counts, window).sequences() == sequences_one_by_one(counts, window)
    assert bin_slack.best_plan({}, window).sequences() == 0


def test_perfect_triples_and_pairs_are_found():
    rng = random.Random(5)
    counts = {}
    for _ in range(3000):
        a, b = sorted(rng.sample(range(1, 1024), 2))
        for k in (a, b - a, 1024 - b):
            counts[k] = counts.get(k, 0) + 1
    assert bin_slack.best_plan(counts, 1024).sequences() <= 3003
    large = {600: 50, 424: 30, 420: 20, 4: 20}
    assert bin_slack.best_plan(large, 1024).sequences() == 50 == bin_slack.fewest(large, 1024)


def test_steps_do_not_grow_with_the_number_of_pieces():
    counts = {k: 10**9 + k * 7919 for k in range(1, 1025)}
    plan = bin_slack.best_plan(counts, 1024)
    assert len(plan.bins) < 1024 * 8
    assert plan.sequences() <= bin_slack.fewest(counts, 1024) * 1.001


def test_cut():
    assert bin_slack.cut(1, 8) == [(0, 1)]
    assert bin_slack.cut(8, 8) == [(0, 8)]
    assert bin_slack.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]
    assert bin_slack.cut(16, 8) == [(0, 8), (8, 8)]


def docs(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(10**6, None), (None, "a b"), (10**6 + 1, ""), (7_000_000, "twice"), (7_000_000, "twice")]
    odd += [(10**6 + 2, "long text " * 20_000), (10**6 + 3, "<|endoftext|>")]
    odd += [(2 * 10**6 + i, "same") for i in range(400)]
    return table.union(spark.createDataFrame(odd, "doc_id long, text string")).repartition(7)


def check(rows, texts, window, end):
    library = Tokenizer.from_file(vocabulary())
    places, documents = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append(r)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
    for doc_id, text in texts:
        want = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4").tobytes()
        parts = sorted(documents[doc_id], key=lambda r: r["piece"])
        if doc_id == 7_000_000:
            assert [r["ids"] for r in parts] == [want, want] and {r["piece"] for r in parts} == {0}
            continue
        assert b"".join(r["ids"] for r in parts) == want
        assert [(r["piece"], r["start"], r["length"]) for r in parts] == [
            (n, *piece) for n, piece in enumerate(bin_slack.cut(len(want) // 4, window))
        ]
    assert len(documents) == len({i for i, _ in texts})
    sizes = {}
    for r in rows:
        sizes[r["length"]] = sizes.get(r["length"], 0) + 1
    return len(places), bin_slack.fewest(sizes, window)


@pytest.mark.parametrize("most_mb", [128, 0])
def test_every_id_once_in_few_sequences(spark, monkeypatch, most_mb):
    monkeypatch.setattr(bin_slack, "COUNTS_MB", most_mb)
    table = docs(spark)
    rows = bin_slack.pack(table.selectExpr("*", "1 AS n", "'x' AS task", "2 AS before"), vocabulary()).collect()
    made, least = check(rows, [tuple(r) for r in table.collect()], 1024, 2)
    assert made <= least + 1


def test_small_window(spark):
    table = docs(spark).where("doc_id < 50 or doc_id > 1000000")
    rows = bin_slack.pack(table, vocabulary(), window=32, end=0).collect()
    made, least = check(rows, [tuple(r) for r in table.collect()], 32, 0)
    assert made <= least + 1


def test_query_and_empty_table(spark, tmp_path):
    table = docs(spark)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_bin_slack(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    found = rows.where("doc_id = 1000000").collect()
    assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found] == [
        (0, 0, 1, zlib.crc32((2).to_bytes(4, "little")))
    ]
    assert bin_slack.pack(table.limit(0), vocabulary()).collect() == []
