"""Periodic runs against a plain search for every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from assaykit.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, times=4):
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q) and i > start:
                best.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, m, q) for (s, m), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    kinds, words = rng.choice([1, 2, 3, 50]), []
    for _ in range(rng.randrange(6)):
        base = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 20))]
        words += (base * rng.randrange(1, 9))[: rng.randrange(1, 150)] if rng.random() < 0.7 else base
    return words


def test_cover_reaches_every_distance():
    steps = {(b - a) % periodic.PERIOD for a in periodic.COVER for b in periodic.COVER}
    assert steps == set(range(periodic.PERIOD))


@pytest.mark.parametrize("seed", range(4))
def test_extensions_equal_plain_comparison(seed):
    rng = np.random.default_rng(seed)
    body = np.tile(rng.integers(0, 3, rng.integers(1, 90)), 12)
    body[rng.integers(0, len(body), 3)] = 5
    codes = np.append(body, 9)
    one, other = rng.integers(0, len(codes), (2, 400))
    one, other = one[one != other], other[one != other]
    got = periodic.Extension(codes)(one, other)
    for a, b, n in zip(one.tolist(), other.tolist(), got.tolist(), strict=True):
        m = max(a, b)
        differs = np.flatnonzero(codes[min(a, b) : len(codes) - (m - min(a, b))] != codes[m:])
        assert n == differs[0]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_plain_search(monkeypatch, seed):
    monkeypatch.setattr(periodic, "PAIRS", 64)
    rng = random.Random(seed)
    for _ in range(25):
        docs = [some_words(rng) for _ in range(rng.randrange(1, 8))]
        docs += docs[:1]
        n_words, runs, texts = periodic._scan(pa.array([" ".join(d) for d in docs]), 6, 4)
        for words, n, found, text in zip(
            docs, n_words.to_pylist(), runs.to_pylist(), texts.to_pylist(), strict=True
        ):
            want = plain_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in found] == want
            assert n == len(words) and text == collapsed(words, want)


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def test_query_equals_plain_search(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(some_words(rng)) for _ in range(300)]
    texts += [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "é\x1cü\x85 " * 9, "same row", "same row"]
    texts += ["x y\x0b" * 4000, " ".join(str(rng.randrange(40)) for _ in range(6000))]
    rows = [(None if i == 7 else i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "b b b b b b", "y", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, words string, n int").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(expected(i, t)) for i, t, _, _ in rows)
    ids = [i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(ids) > 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    found = periodic.find(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"] and found.collect() == []


def test_long_text():
    words = ["a", "b", "c"] * 60_000 + ["x"] + ["a", "b"] * 50_000
    _, runs, text = periodic._scan(pa.array([" ".join(words)]), 6, 4)
    assert [tuple(r.values()) for r in runs[0].as_py()] == [(0, 180_000, 3), (180_001, 100_000, 2)]
    assert text[0].as_py() == "a b c x a b"
