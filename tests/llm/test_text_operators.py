"""Quality rules, decontamination, licenses, language, URLs and secrets against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaykit.llm import (
    decontamination,
    language_id,
    licenses,
    quality,
    secret_scan,
    url_filters,
)
from assaykit.llm.queries import URL_LISTS

LONG = "word other thing " * 9000
TEXTS = [
    None,
    "",
    "   \n\t ",
    "one two three one two three one two three",
    "a b c d\na b c d\n\na b c d\x0bx",
    "The cat and the dog!! #1 | 50% <b>",
    "é\x1cü two\x85words ‏x",
    LONG,
    "same row",
    "same row",
]


def frame(spark, texts=TEXTS):
    rows = [(i if i != 2 else None, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, row long")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_measure(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        i + k
        for i, w in enumerate(zip(words, words[1:], words[2:], strict=False))
        if windows[w] > 1
        for k in range(3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts(spark):
    got = quality.judge(quality.measure(frame(spark))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter(
        (i if i != 2 else None, *plain_measure(t)) for i, t in enumerate(TEXTS)
    )
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_quality_keep_returns_the_rows(spark):
    good = " ".join(f"the {a}{b} was {b}{a}," for a in "bcdfghjk" for b in ("ale", "oor", "ink"))
    docs = frame(spark, [good, "% " * 80, None])
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]
    assert quality.keep(docs.limit(0)).count() == 0


def test_quality_keeps_clean_text_of_other_languages_and_in_capitals(spark):
    pairs = [(a, b) for a in "bdfgklmnprst" for b in ("ale", "ork", "ink", "umt", "epf")]
    latin = " ".join(f"{a}{b} {b}{a}" for a, b in pairs)
    russian = " ".join(f"мы{chr(0x430 + i % 32)}ш{chr(0x430 + i // 2)} идёт" for i in range(40))
    polish = " ".join(f"{a}ał{b} {b}ę{a}" for a, b in pairs)
    turkish = " ".join(f"{a}ı{b} {b}ş{a}" for a, b in pairs)
    shouted = " ".join(f"THE {a}{b} WAS {b}{a}".upper() for a, b in pairs)
    chinese = " ".join("".join(chr(0x4E00 + 31 * i + k) for k in range(25)) for i in range(60))
    docs = frame(spark, [russian, polish, None, turkish, shouted, chinese, latin])
    assert sorted(r["doc_id"] for r in quality.keep(docs).collect()) == [0, 1, 3, 4, 5]
    judged = {r["doc_id"]: r for r in quality.judge(quality.measure(docs)).collect()}
    assert [i for i, r in judged.items() if i is not None and r["kept"]] == [0, 1, 3, 5]
    assert judged[6]["failed_rules"] == "stop_ratio"


ITEM = "If Anna buys 12 red apples for 30 dollars then how many apples does Anna get for 45 dollars today"


def changed(**values):
    text = ITEM
    for old, new in values.items():
        text = re.sub(rf"\b{old.strip('_')}\b", new, text)
    return text


def test_decontamination_finds_reparameterised_items(spark):
    texts = [
        "Some words first. " + ITEM + ". And more.",
        "Intro, " + changed(Anna="Berta", _12="7", _30="9", _45="81"),
        # the name takes two values, which no one re-parameterisation gives
        ITEM.replace("does Anna", "does Carla"),
        "If the cat sat on the mat then nobody buys apples at all today or ever again",
        None,
        "",
        ITEM + " " + ITEM,
        ITEM,
        ITEM,
    ]
    benchmark = spark.createDataFrame(
        [(5, ITEM, "x"), (3, ITEM, "y"), (9, "too short", None), (None, ITEM, ""), (8, None, "")],
        "item_id long, text string, doc_id string",
    )
    docs = frame(spark, texts)
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.find(docs, benchmark).collect()}
    # document 2 has a null id in this frame
    assert set(got) == {(0, 3), (1, 3), (6, 3), (7, 3), (8, 3)}
    assert got[0, 3]["exact"] and not got[1, 3]["exact"] and got[1, 3]["n_changed"] >= 4
    assert decontamination.find(docs, benchmark.limit(0)).count() == 0
    assert decontamination.find(docs.limit(0), benchmark).count() == 0


def test_decontamination_refuses_inconsistent_slots(spark):
    whole = decontamination.benchmark_windows(
        spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    ).count()
    bad = ITEM.replace("does Anna", "does Carla")
    docs = spark.createDataFrame([(1, bad)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontamination.find(docs, bench, least_windows=whole).count() == 0


def found_items(spark, texts, items, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontamination.find(docs, bench, **kw).collect()}


def test_decontamination_counts_the_largest_consistent_part(spark):
    far = "Every morning the tall baker sells 12 loaves near the old stone bridge by the quiet river "
    item = far + "and every evening the same baker counts what is left of the 12 loaves on the big table"
    texts = [item, item[::-1].replace("21", "7", 1)[::-1], item.replace("12", "7"), "no words of it"]
    assert texts[1].count("12") == 1
    got = found_items(spark, texts, [item])
    assert set(got) == {(0, 0), (1, 0), (2, 0)}
    whole, part, renamed = (got[i, 0] for i in range(3))
    # left out are the windows that hold the changed number, which has 5 tokens behind it
    assert whole["n_windows"] == renamed["n_windows"] == part["n_windows"] + 6
    assert part["exact"] and not renamed["exact"]


def test_decontamination_finds_short_items(spark):
    items = [
        "why do some birds fly south before winter",  # 8 tokens, one window
        "why do some fish swim upstream every single spring",  # 9 tokens
        "name the largest moon of saturn",  # 6 tokens
        "12 + 7 - 3 + 9 - 4 + 6 + 8 sums to",  # no window with 5 plain words
        "too short",
    ]
    texts = [f"Some text before, {x}, and some text behind" for x in items]
    texts.append("Before, 13 + 7 - 3 + 9 - 4 + 6 + 8 sums to")
    assert set(found_items(spark, texts, items)) == {(i, i) for i in range(4)}


def test_licenses_base_places(spark):
    texts = [
        *TEXTS,
        "GNU General\nPublic-License; gnu general public license, MIT License. CC  BY cc by",
        "xmit license mit licensex cc by-nc",
        "Permission is hereby granted, free of charge, to ani person",
        "Licensed under the Apache Lisense, Version 2.0.",
    ]
    got = licenses.scan(frame(spark, texts)).collect()
    by_id = {r["doc_id"]: r for r in got}
    for i, text in enumerate(texts):
        if i == 2:
            continue
        low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (k, label)
            for phrase, label in licenses.PHRASES.items()
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        r = by_id[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places)), i
        assert r["first_word"] == min((k for k, _ in places), default=None)
        assert r["last_word"] == max((k for k, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    n = len(TEXTS)
    assert by_id[n + 2]["labels"] == "mit" and 0.9 < by_id[n + 2]["score"] < 1
    assert by_id[n + 3]["labels"] == "apache" and by_id[n + 3]["n_base"] == 0
    assert licenses.scan(frame(spark).limit(0)).count() == 0


def test_license_pieces_cover_every_bounded_edit():
    rng = np.random.default_rng(3)
    scanner = licenses.Scanner()
    for notice in licenses.NOTICES:
        for _ in range(20):
            text = notice.text
            for at in rng.choice(len(text), notice.edits, replace=False):
                kind = rng.integers(3)
                text = text[:at] + ("q" if kind else "") + text[at + (kind != 1) :]
            found = scanner.fuzzy(f"start {text} end")
            assert any(f.edits <= notice.edits for f in found), (notice.text, text)


def test_adjacent_license_notices_are_all_found():
    scanner = licenses.Scanner()
    spans = [(f.start, f.end, f.edits) for f in scanner.fuzzy("the mit licence the mit license")]
    assert spans == [(0, 15, 1), (16, 31, 0)]
    rng = np.random.default_rng(7)
    notice = licenses.Notice("redistribution and use in source and binary forms", "bsd", 4)
    scanner = licenses.Scanner({}, (notice,))
    for _ in range(30):
        edits = rng.integers(0, 4, 6).tolist()
        copies = [notice.text.replace("u", "q", n) if n < 3 else notice.text.replace("i", "q", n) for n in edits]
        found = scanner.fuzzy(" ".join(copies))
        assert len(found) == 6 and [f.start for f in found] == [50 * i for i in range(6)]


def test_suffix_automaton_parses_like_a_search():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 3, 300).astype(np.uint8)
    table = language_id.suffix_automaton(text, 4)
    whole = bytes(text)
    queries = [rng.integers(0, 4, n).astype(np.uint8) for n in (1, 7, 40, 200)]
    for query in queries:
        count, at = 0, 0
        while at < len(query):
            size = 1
            while at + size <= len(query) and bytes(query[at : at + size]) in whole:
                size += 1
            at += max(1, size - 1)
            count += 1
        row = np.zeros((1, len(query)), dtype=np.uint8)
        row[0] = query
        assert language_id.phrases(row, np.array([len(query)]), table).tolist() == [count]


def many_scripts():
    """Two languages each of four scripts; the two differ in the order of the same letters."""
    rng = np.random.default_rng(11)
    texts = {}
    for first, size in ((0x61, 26), (0x430, 32), (0x4E00, 1500), (0xAC00, 1200)):
        for k in (0, 1):
            words = ["".join(chr(first + c) for c in rng.integers(0, size, 4)) for _ in range(300)]
            texts[f"{first:x}-{k}"] = [" ".join(rng.choice(words, 60)) for _ in range(40)]
    return texts


@pytest.mark.parametrize("most_bytes", [0, 1 << 40])
def test_languages_of_large_alphabets_are_told_apart(most_bytes):
    texts = many_scripts()
    model = language_id.fit({k: t[:30] for k, t in texts.items()}, 9000, most_bytes)
    assert all(isinstance(t, np.ndarray) == (most_bytes > 0) for t in model.tables)
    for name, each in texts.items():
        found = language_id.predict(each[30:], model)
        assert {lang for lang, _ in found} == {name} and min(score for _, score in found) > 0.3


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(12)
    rows = []
    for n in range(300):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(12)]
        rows += [(i, " ".join(words), f"l{n:03}") for i in (1, 2, 3, 4) for _ in range(1 + (n < 256))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language_id.train(docs).languages) == 300


def test_language_is_learned_and_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(table)
    held = table.where(language_id.held_out(F.col("doc_id")))
    rows = language_id.identify(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    odd = {r["doc_id"]: r for r in language_id.identify(frame(spark, [None, "", "12 %", "the"]), model).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1)] == ["und", "und"] and odd[3]["lang_pred"] != "und"
    empty = language_id.train(table.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(frame(spark), empty).collect()} == {"und"}


URLS = [
    None, "", "no scheme", "http://a.com", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/",
    "http://example.com/EN/", "x://y.net/fr/1#t", "x://y.net/es", "x://net/es/", "http://.com/",
    "http://com/?x", "ftp://www.example.com/en/#a://b", "http://blog.casino-win.example.org/en/1",
    "http://host\nline.com/a", "http://y.com?/x", "http://example.com.org/en/", "http://y.com/", "http://y.com/",
]


def plain_verdict(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub(r"[A-Z]", lambda m: m[0].lower(), host)

    def fitting(rules):
        for rule in rules:
            rule_host, cut, rule_path = rule.partition("/")
            same = host == rule_host or host.endswith("." + rule_host)
            if same and host and path.startswith(cut + rule_path):
                yield rule

    verdicts = dict.fromkeys(URL_LISTS.block, "block") | dict.fromkeys(URL_LISTS.allow, "allow")
    best = max(fitting(verdicts), key=len, default=None)
    more = "block" if list(fitting(URL_LISTS.more)) else "allow"
    return host, path, best, verdicts.get(best, more)


def test_url_verdicts(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filters.judge(pages, URL_LISTS).collect()
    assert {r["page_id"]: tuple(r)[1:] for r in got} == {i: plain_verdict(u) for i, u in enumerate(URLS)}
    assert url_filters.judge(pages.limit(0), URL_LISTS).count() == 0


def test_filter_cascade_is_exact(spark):
    n = 20_000
    keys = spark.range(n).select(
        F.xxhash64("id").alias("first"), F.xxhash64("id", F.lit("s")).alias("second"), "id"
    )
    levels = url_filters.build(keys, keys.where("id % 7 = 0"))
    rows = keys.toPandas()
    found = url_filters.lookup(
        levels, *(rows[c].to_numpy().view(np.uint64) for c in ("first", "second"))
    )
    assert len(levels) > 1 and (found == (rows["id"] % 7 == 0).to_numpy()).all()


SECRETS = [
    *TEXTS,
    'password = "abcdef" Passwd:abc token=token:abcdefgh SECRET="x.y-z+/=1" api_key:123456 apikey\n=zzzzzz',
    "é AKIA" + "A1" * 8 + " AKIASHORT xAKIA" + "B" * 40,
    "0123456789abcdef01234567 0123456789abcdef0123456 " + "a" * 30 + "g" + "f" * 24,
    "token=" + "0f" * 20,
    "ghp_" + "a1B2" * 9 + " and -----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
]


def plain_spans(text):
    found = []
    for order, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), order, f"{rule.kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(found))


def test_secret_spans(spark):
    docs = frame(spark, SECRETS)
    got = secret_scan.scan(docs).select("doc_id", secret_scan.listed(F.col("spans")).alias("s")).collect()
    want = Counter((i if i != 2 else None, plain_spans(t)) for i, t in enumerate(SECRETS))
    assert Counter((r["doc_id"], r["s"]) for r in got) == want
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_base_rules_as_stated():
    stated = {"access": (r"AKIA[A-Z0-9]+", 20), "hex": (r"[0-9a-f]+", 24)}
    rng = np.random.default_rng(1)
    for rule in secret_scan.BASE_RULES[1:]:
        pattern, least = stated[rule.kind]
        for _ in range(300):
            text = "".join(rng.choice(list("AKIA0afAKIAz "), 120))
            text += "AKIA" * 9 + "af09" * 6
            want = [m.span() for m in re.finditer(pattern, text) if len(m[0]) >= least]
            assert [m.span() for m in re.finditer(rule.pattern, text)] == want


def test_redaction(spark):
    docs = frame(spark, SECRETS).withColumn("secret_spans_", F.lit(1))
    found = secret_scan.scan(docs, keep_rows=True)
    text = secret_scan.redacted(F.col("text"), F.col("secret_spans"))
    rows = {r["row"]: r for r in found.select("row", "text", text.alias("clean")).collect()}
    assert rows[0]["clean"] is None and rows[7]["clean"] == LONG
    assert rows[len(TEXTS) + 3]["clean"] == "[assign]"
    assert rows[len(TEXTS) + 1]["clean"] == "é [access] AKIASHORT x[access]"


@pytest.mark.parametrize(
    ("pattern", "query"),
    [
        ("abcd", ("and", ("abc", "bcd"))),
        ("ABCD+", "abc"),
        ("(?:abc|xyz)?", None),
        ("a[0-9]+b", None),
        ("abc|xy", None),
        ("abc.*def", ("and", ("abc", "def"))),
        ("(?:abc)+", "abc"),
        ("(?i:pass|word)x?", ("or", (("and", ("ass", "pas")), ("and", ("ord", "wor"))))),
    ],
)
def test_trigram_queries(pattern, query):
    assert secret_scan.trigram_query(pattern) == query


def test_license_scan_is_linear_in_repeated_notices():
    scanner = licenses.Scanner()
    for text, label in (("released under the mit license", "mit"), ("released under teh mit license", "mit")):
        words = len(text.split())
        for copies in (1, 3, 2000):
            row = licenses._row(scanner, " ".join([text] * copies))
            spans = [(s["first"], s["last"]) for s in row[-1] if s["notice"] == "released under the mit license"]
            assert spans == [(i * words, i * words + words - 1) for i in range(copies)]
            assert row[0] == words * copies and label in row[5].split(",")
