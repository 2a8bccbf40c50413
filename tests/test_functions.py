"""Text and JSON functions against plain Python."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions import strict_json as sj
from assaykit.functions import text as tx


def column(spark, values, name="t"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def results(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def test_normalization_is_python_normalization(spark):
    values = ["Straße ÉTÉ", "ﬁne ½ cup", "a\u0301b", "ＦＵＬＬ width", "[ORDER_ID] is\tlate!", "", "…", "İstanbul", "x_y‿z"]
    values += [f"A{chr(c)}b" for c in range(0x20, 0x2100)]
    want = [
        " ".join(re.sub(r"[^\w]+", " ", unicodedata.normalize("NFKC", v).casefold()).split()) for v in values
    ]
    assert results(tx.with_normalized(column(spark, values), F.col("t")), "normalized") == want


def test_strip_matches_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{s}{s}a b{s}" for s in spaces] + ["", "  ", "\u200bx"]
    assert results(column(spark, values).select("i", tx.strip_text("t").alias("s")), "s") == [v.strip() for v in values]


MAIL, SOCIAL, CARD, PHONE = fv.PII_PATTERNS
PII_CASES = {
    "write to a.b@c.de please": [MAIL],
    "A.B%C+d@SUB-1.example.ORG": [MAIL],
    "é+@x.com": [MAIL],
    "x@y": [],
    "id 123-45-6789.": [SOCIAL],
    "id 123-45-6789 ok": [SOCIAL, PHONE],
    "٣٣٣-٣٣-٣٣٣٣": [SOCIAL, PHONE],
    "9123-45-6789": [PHONE],
    "4111 1111 1111 1111": [CARD, PHONE],
    "4111-1111-1111-1111-2222": [CARD, PHONE],
    "+49 (30) 123-45678": [PHONE],
    "12345678": [PHONE],
    "word 1234567": [],
    "A12345678": [],
    "1.5": [],
    "a@b.cc 87654321": [MAIL, PHONE],
    "": [],
}


def test_pii_cases(spark):
    got = results(column(spark, list(PII_CASES)).select("i", tx.pii_hits(F.col("t")).alias("h")), "h")
    assert dict(zip(PII_CASES, got, strict=True)) == PII_CASES


SECRET_CASES = {
    "Authorization: Bearer abc.def, next": "Authorization: [REDACTED], next",
    "my_token=1": "my_token=1",
    "TOKEN = x;y": "TOKEN = [REDACTED];y",
    "api-key:k apikey : z": "api-key:[REDACTED] apikey : [REDACTED]",
    "hf_" + "a1" * 12: "[REDACTED]",
    "xhf_" + "a" * 24: "xhf_" + "a" * 24,
    "hf_" + "a" * 24 + "-": "[REDACTED]-",
    "hf_short": "hf_short",
    "password:\u00a0p": "password:\u00a0[REDACTED]",
    "ſecret=1": "ſecret=[REDACTED]",
    "none": "none",
}


def test_secret_cases(spark):
    got = results(column(spark, list(SECRET_CASES)).select("i", tx.redact_secrets(F.col("t")).alias("r")), "r")
    assert dict(zip(SECRET_CASES, got, strict=True)) == SECRET_CASES
    long = column(spark, ["x" * 5000]).select("i", F.length(tx.sanitize_error(F.col("t"))).alias("n"))
    assert results(long, "n") == [4000]


CASES = {
    '{"a":1}': (True, '{"a":1}', None),
    ' \u00a0{"a":{"b":[1,2]}}\n': (True, '{"a":{"b":[1,2]}}', None),
    '{"a":1} tail': (False, '{"a":1}', None),
    '{"a":1}] {}': (False, '{"a":1}', None),
    '{"a":1},{"b":2}': (False, '{"a":1}', None),
    '[{"a":1}]': (False, '{"a":1}', None),
    "x ```json\n{\"a\":1}\n``` y": (False, '{"a":1}', None),
    "so {not json} but {\"b\":2}": (False, '{"b":2}', None),
    '{"a":1,"a":2}': (False, None, "duplicate JSON object key: 'a'"),
    'see {"a":{"q":1,"q":1}} then {"b":1}': (False, None, "duplicate JSON object key: 'q'"),
    '{"a":NaN}': (False, None, "non-finite JSON constant is not permitted: NaN"),
    '{"a":-Infinity}': (False, None, "non-finite JSON constant is not permitted: -Infinity"),
    "{'a':1}": (False, None, None),
    '{"a":"x\ty"}': (False, None, None),
    '"text"': (False, None, None),
    "": (False, None, None),
}


def test_strict_and_recovered_objects(spark):
    df = sj.with_object(column(spark, list(CASES)), "t", "j").select(
        "i", F.struct("j_strict", F.to_json("j_object").alias("o"), "j_error").alias("x")
    )
    assert [tuple(x) for x in results(df, "x")] == list(CASES.values())


def test_jvm_and_python_parsers_agree(spark):
    rng = random.Random(5)
    bits = ['{', '}', '"a"', ':', '1', ',', '[', ']', '"b"', 'null', ' ', '{"k":2}', 'true', '-1.5e3', '\\']
    values = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    values += ["{" + v + "}" for v in values]
    got = results(column(spark, values).select("i", sj.parse_object(F.col("t")).isNotNull().alias("ok")), "ok")
    for value, ok in zip(values, got, strict=True):
        try:
            pairs = []
            loaded = json.loads(value.strip(), object_pairs_hook=lambda p: pairs.append(p) or dict(p))
            strict = isinstance(loaded, dict) and all(len(dict(p)) == len(p) for p in pairs)
        except json.JSONDecodeError:
            strict = False
        assert ok == strict, value


def test_small_text_checks(spark):
    df = column(spark, ["/a", "a/b.json", "a/../b", "./a", "a//b", "", "a/"]).select(
        "i", tx.relative_path_ok(F.col("t")).alias("ok"))
    assert results(df, "ok") == [False, True, False, False, False, False, False]
    df = column(spark, ["a" * 64, "ab" * 32, "AB" * 32, None]).select("i", tx.real_digest(F.col("t")).alias("ok"))
    assert results(df, "ok") == [False, True, False, False]
    df = column(spark, ["one cue", "one and two", "nil"]).select(
        "i", tx.only_cue(F.col("t"), ["one", "two"], F.lit("one")).alias("ok"))
    assert results(df, "ok") == [True, False, False]
    df = column(spark, ["C:\\Users\\me", "/home/ok/x", "/srv"]).select(
        "i", tx.local_user_path(F.col("t"), ["/home/ok"]).alias("bad"))
    assert results(df, "bad") == [True, False, False]


@pytest.mark.parametrize("value,ok", [("10.0.0.1", True), ("see https://x.io", True), ("[IP] only", False)])
def test_extended_pii(spark, value, ok):
    row = column(spark, [value]).select("i", F.size(tx.extended_pii_hits(F.col("t"))).alias("n")).first()
    assert (row["n"] > 0) == ok


@pytest.mark.parametrize("tail, strict", [
    ("", True), (" \n", True), ("]", False), ("}", False), ('] {"a":1}', False), (",1", False),
    (',"x"]', False), (" x", False),
])
def test_a_text_is_parsed_once_and_to_its_end(spark, tail, strict):
    """A tail that closes the array around the text, or adds to it, is seen with one parse."""
    text = '{"a":{"b":"ü"},"c":[1]}' + tail
    rows = sj.with_object(spark.createDataFrame([(text,)], "t string"), "t")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('concat({"k":') == 0
    got = rows.select("json_strict", F.to_json("json_object").alias("o")).first()
    # a text with something behind the object is recovered, but not strict
    assert tuple(got) == (strict, '{"a":{"b":"ü"},"c":[1]}')


def test_long_text_is_trimmed_as_a_field(spark):
    texts = ["", " ", "a", " a", "a ", " a", "a　", "é", "aé ", "~!", "\x1ca\x1c", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for strip in (tx.strip_field, tx.strip_text):
        got = rows.select(tx.strip_long(F.col("t"), strip).alias("a"), strip("t").alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]
