"""Source divergence against a dense plain computation."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from assaykit.llm import divergence

SCHEMA = "lang string, source string, text string, rank int, term string, p long"


def plain(rows, least=3, ranks=200):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    counts, spread, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(found)
        spread[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in spread[lang].items() if n >= least)
        own = {s: counts[lang, s] for g, s in groups if g == lang}
        own[None] = sum(own.values(), Counter())
        p = {}
        for s, c in own.items():
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        def apart(a, b):
            return (a - b) ** 2 // b

        for s in own:
            if s is None:
                continue
            pairs = [
                (-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode(), o)
                for o in own if o is not None and o != s
            ]
            terms = [
                (-apart(p[s][t], p[None][t]), t.encode(), t)
                for t in kept if own[s][t] and p[s][t] > p[None][t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                for rank, (value, _, item) in enumerate(sorted(found)[:most], 1):
                    out.add((lang, s, part, item, -value, rank))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Wa", "wé", "日", "zZ") for b in "abcdefghijklmnop"]
    weight = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for _ in range(n):
        source = rng.choice(["hot"] * 5 + ["s1", "s2", "ß", None, ""])
        some = rng.choices(vocabulary, weight, k=rng.randrange(0, 30))
        rows.append((rng.choice(["en", "en", "de", None]), source, rng.choice([" ", "1", ", "]).join(some)))
    rows += [("en", "empty", None), ("en", "none", "123 --"), ("xx", "a", "only once"), ("xx", "b", "")]
    rows += [("yy", "alone", "one two")] * 3
    return rows


@pytest.mark.parametrize("unit_bytes, sums", [(10**9, 1 << 24), (4000, 100)])
def test_equals_dense_computation(spark, monkeypatch, unit_bytes, sums):
    rows = corpus(3, 300)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(divergence, "BLOCK", 10)
    monkeypatch.setattr(divergence, "SUMS", sums)
    monkeypatch.setattr(divergence, "CHUNK", 1 << 14 if sums > 100 else 10)
    found = divergence.audit(docs, most_ranks=5, unit_bytes=unit_bytes)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, ranks=5)


def test_only_latin_capitals_are_lowered(spark):
    texts = ["ABC xyZ", "ÀB É ß ẞ", "ΑΣ ΟΔΟΣ Σ", "İI ıi", "Ⅳ ⅳ Ⓐ", "ǅ Ǆ ǆ", "АБ аб", "K Å Ω", "𐐀a", "", "é à Ü"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for r in rows.select("text", divergence.terms_of(rows["text"]).alias("t")).collect():
        assert [t for t in r["t"] if t] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r["text"].translate(lower))


@pytest.mark.parametrize("most", [1 << 16, 40, 1])
def test_documents_are_run_together_by_group(spark, monkeypatch, most):
    """A task hands on few long rows, from which every document's terms can be told."""
    monkeypatch.setattr(divergence, "JOINED", most)
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    rows = [(a or "", b or "", c or "") for a, b, c in corpus(4, 200)]
    rows += [("en", "s1", "a\nb \n c"), ("en", "s1", "\n \n"), ("de", "s1", "É ß ẞ\x00İI_Σ"), ("de", "s2", "\x7fÀB\x85x")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    found = divergence.joined(docs).collect()
    if most == 1 << 16:
        assert len(found) <= len({r[:2] for r in rows})
    got = sorted((r["lang"], r["source"], d) for r in found for d in r["text"].split(" \n "))
    texts = [(a, b, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", c.translate(lower))) for a, b, c in rows]
    assert got == sorted((a, b, " ".join(words)) for a, b, words in texts if words)


@pytest.mark.parametrize("least", [1, 2, 3, 50])
def test_spread_counts_documents_up_to_the_least(spark, least):
    rng = random.Random(7)
    rows = [("en", rng.choice("ab"), " ".join(rng.choice("uvwxyz") * rng.randrange(1, 3) for _ in range(5))) for _ in range(90)]
    rows += [("en", "a", "u u u u"), ("en", "b", "1 2")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    found = divergence.joined(docs, least).collect()
    documents, in_rows, tokens = Counter(), Counter(), 0
    for _, source, text in rows:
        documents.update({(source, t) for t in re.findall("[a-z]+", text)})
    for r in found:
        for layer in r["spread"]:
            tokens += len(layer.split(" "))
            in_rows.update({(r["source"], t) for t in layer.split(" ")})
    assert len(found) == 2
    assert in_rows == {key: min(n, least) for key, n in documents.items()}
    assert tokens == sum(in_rows.values())


def test_large_counts_stay_exact(spark):
    rows = spark.createDataFrame([(c, 10**12, 7) for c in (0, 9 * 10**9, 10**10, 10**12)], "count long, total long, kept long")
    for r in rows.select("count", divergence._share("count").alias("p")).collect():
        assert r["p"] == 1 + 10**9 * (r["count"] + 1) // (10**12 + 7)


def test_long_text_and_one_group(spark):
    rows = [("en", "a", "word Other thing " * 30_000), ("en", "a", "word"), ("en", "b", "word other")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert {tuple(r) for r in divergence.audit(docs).collect()} == plain(rows)


def test_empty_table_and_nothing_kept(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(docs).collect() == []
    rows = [("en", "a", "one"), ("en", "b", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert {tuple(r) for r in divergence.audit(docs).collect()} == {
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1),
    }


@pytest.mark.parametrize("most", [(1, 1 << 24, 1 << 19), (1 << 18, 1 << 24, 1), (1 << 18, 1 << 24, 1 << 19)])
def test_counts_are_rows_of_weights(spark, monkeypatch, most):
    for name, value in zip(("JOINED", "HELD_BYTES", "HELD_TERMS"), most, strict=True):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(11)
    rows = [("en", rng.choice("ab"), " ".join(rng.choice("uvwxyz") for _ in range(rng.randrange(1, 200)))) for _ in range(60)]
    rows += [("en", "a", "u " * 5000), ("en", "b", "1 2")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    found = divergence.joined(docs, texts=False).collect()
    want, got, tokens = Counter(), Counter(), 0
    for _, source, text in rows:
        want.update((source, t) for t in re.findall("[a-z]+", text))
    for r in found:
        assert r["text"] is None
        for bit, row in enumerate(r["counts"]):
            words = row.split(" ") if row else []
            tokens += len(words)
            assert len(set(words)) == len(words)
            for t in words:
                got[r["source"], t] += 1 << bit
    assert got == want
    if most[2] > 1 and most[0] > 1:
        assert len(found) == 2 and tokens < sum(want.values()) / 50


@pytest.mark.parametrize("unit_bytes", [10**9, 2000])
def test_one_vocabulary_at_a_time(spark, monkeypatch, unit_bytes):
    """The sums of a vectorizer are written before the next one's vocabulary comes to the driver."""
    rows, steps = corpus(5, 200), []

    def noted(name, f):
        def call(*args, **kwargs):
            steps.append(name(*args))
            return f(*args, **kwargs)

        return call

    monkeypatch.setattr(divergence.CountVectorizer, "fit", noted(lambda *_: "fit", divergence.CountVectorizer.fit))
    monkeypatch.setattr(divergence, "written", noted(lambda _, name, *__: name, divergence.written))
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    assert {tuple(r) for r in divergence.audit(docs, unit_bytes=unit_bytes).collect()} == plain(rows)
    steps = [s for s in steps if s in ("fit", "sums")]
    assert len(steps) >= 8 and steps == ["fit", "sums"] * (len(steps) // 2)
