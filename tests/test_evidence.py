"""The chain of evidence: every planted fault is found, and nothing else."""

import hashlib

from pyspark.sql import functions as F

from assaykit.operators import evidence


def digest(name):
    return hashlib.sha256(name.encode()).hexdigest()


def problems(spark, names, claims, roots=("source",)):
    nodes = spark.createDataFrame([(n, digest(n)) for n in names], "name string, digest string")
    edges = spark.createDataFrame(
        [(c, r, p, digest(p) if d is True else d) for c, r, p, d in claims],
        "child string, role string, parent string, declared string",
    )
    return {(r["child"], r["parent"]): r["problem"] for r in evidence.walk(nodes, edges, roots).collect()}


def test_an_unbroken_chain_has_no_problem(spark):
    names = ["source:a", "split:a", "manifest:a", "report:a"]
    claims = [("split:a", "source", "source:a", True), ("manifest:a", "source", "source:a", True),
              ("manifest:a", "split", "split:a", True), ("report:a", "manifest", "manifest:a", True)]
    assert set(problems(spark, names, claims).values()) == {None}


def test_every_kind_of_fault(spark):
    names = ["source:a", "m", "p", "r", "x", "y", "lone", "two"]
    claims = [
        ("m", "source", "source:a", digest("other")),
        ("p", "manifest", "m", True), ("r", "predictions", "p", True),
        ("r", "extra", "gone", True), ("p", "source", "source:a", None),
        ("x", "draft", "y", True), ("y", "draft", "x", True),
        ("two", "source", "source:a", True), ("two", "source", "m", True),
    ]
    assert problems(spark, names, claims) == {
        ("m", "source:a"): "digest differs", ("p", "m"): "rests on a fault", ("r", "p"): "rests on a fault",
        ("r", "gone"): "unknown parent", ("p", "source:a"): "no digest", ("x", "y"): "no root", ("y", "x"): "no root",
        ("two", "source:a"): "claims disagree", ("two", "m"): "claims disagree", ("lone", None): "claims nothing",
    }


def test_long_chains_are_walked_to_their_root(spark):
    names = ["source:a", *[f"n{i}" for i in range(12)]]
    claims = [(f"n{i}", "before", f"n{i - 1}" if i else "source:a", True) for i in range(12)]
    assert set(problems(spark, names, claims).values()) == {None}
    claims[2] = ("n2", "before", "n1", digest("changed"))
    found = problems(spark, names, claims)
    assert [found[f"n{i}", claims[i][2]] for i in range(12)] == (
        [None] * 2 + ["digest differs"] + ["rests on a fault"] * 9
    )


def test_edges_and_nodes_come_from_the_tables(spark):
    rows = spark.createDataFrame([("a", i, f"line {i}") for i in range(9)] + [("b", 0, "x")], "k string, n long, t string")
    nodes = evidence.observed("set", rows, "n", F.col("t"), ["k"])
    assert {r["name"] for r in nodes.collect()} == {"set:a", "set:b"}
    claimed = evidence.claims(
        rows, F.lit("report"), {"input": (evidence.artifact("set", "k"), F.when(F.col("n") < 5, "d1").otherwise("d2"))}
    )
    assert sorted(tuple(r) for r in claimed.collect()) == [
        ("report", "input", "set:a", "d1", 5), ("report", "input", "set:a", "d2", 4), ("report", "input", "set:b", "d1", 1),
    ]
