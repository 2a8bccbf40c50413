"""The chain of evidence: artifacts that name the digests of what they were made from (J15).

Nodes are artifacts with the digest observed on their rows. Edges are claims: an artifact says that
it was made from another one with a certain digest. Both are derived from the tables themselves:
``observed`` digests the ordered rows of every artifact of a kind, ``claims`` reads the digest
columns that headers or rows carry. ``walk`` follows the claims from the roots.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions.digests import tree_digest
from assaykit.session import durable


def observed(
    kind: str, rows: DataFrame, position: str, line: Column, group: Sequence[str] = ()
) -> DataFrame:
    """(name, digest) of every artifact of a kind; one per value of ``group``, named kind:value."""
    keyed = rows.withColumn("__name", artifact(kind, *group))
    digests = tree_digest(keyed, ["__name"], position, line)
    return digests.select(F.col("__name").alias("name"), "digest")


def artifact(kind: str, *group: str) -> Column:
    return F.concat_ws(":", F.lit(kind), *[F.col(c).cast("string") for c in group])


def claims(rows: DataFrame, child: Column, parents: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(child, role, parent, declared, rows): what rows say of the artifacts they were made from.

    ``parents`` gives the parent's name and the declared digest by role. Equal claims of many rows
    are one edge; rows of one artifact that disagree are several. A row without a digest claims null.
    """
    each = F.array(
        *[
            F.struct(F.lit(role).alias("role"), name.alias("parent"), digest.alias("declared"))
            for role, (name, digest) in parents.items()
        ]
    )
    flat = rows.select(child.alias("child"), F.inline(each))
    return flat.groupBy("child", "role", "parent", "declared").agg(F.count(F.lit(1)).alias("rows"))


def walk(nodes: DataFrame, edges: DataFrame, roots: Sequence[str]) -> DataFrame:
    """(child, role, parent, declared, observed, problem): every claim and what is wrong with it.

    A claim's own faults are: ``no digest`` declared, ``unknown parent``, ``digest differs``, and
    ``claims disagree`` where an artifact names several digests or parents for one role. Then the
    faults of the chain: ``rests on a fault`` if the parent, or what it rests on, has a faulty claim,
    and ``no root`` if following parents never ends in an artifact whose kind (the name up to the
    first colon) is one of ``roots``; circles end in none. Artifacts that are no root and claim
    nothing get a row with the problem ``claims nothing``.

    Claims are followed breadth first: one round per step between the roots and the artifacts
    farthest from them, with the artifacts settled in the last round on one side of each join.
    """
    is_root = F.substring_index("name", ":", 1).isin(list(roots))
    nodes = durable(nodes.select("name", "digest", is_root.alias("root")))
    parents = nodes.select(F.col("name").alias("parent"), F.col("digest").alias("observed"))
    joined = edges.join(parents, "parent", "left")
    several = edges.groupBy("child", "role").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = joined.join(several.select("child", "role", F.lit(True).alias("several")), ["child", "role"], "left")
    own = (
        F.when(F.col("declared").isNull(), "no digest")
        .when(F.col("observed").isNull(), "unknown parent")
        .when(F.col("declared") != F.col("observed"), "digest differs")
        .when(F.col("several"), "claims disagree")
    )
    checked = durable(joined.select("child", "role", "parent", "declared", "observed", own.alias("own")))
    links = checked.select("child", "parent").distinct()

    # what rests on a fault, step by step away from it
    tainted = _spread(checked.where("own IS NOT NULL").select(F.col("child").alias("name")), links)
    # what reaches a root, step by step away from the roots
    rooted = _spread(nodes.where("root").select("name"), links)
    marked = checked.join(
        tainted.select(F.col("name").alias("parent"), F.lit(True).alias("tainted")), "parent", "left"
    ).join(rooted.select(F.col("name").alias("parent"), F.lit(True).alias("rooted")), "parent", "left")
    problem = F.coalesce(
        "own", F.when(F.col("tainted"), "rests on a fault"), F.when(F.col("rooted").isNull(), "no root")
    )
    silent = nodes.where("NOT root").join(links.select(F.col("child").alias("name")), "name", "left_anti")
    nothing = F.lit(None).cast("string")
    lone = silent.select(
        F.col("name").alias("child"), nothing.alias("role"), nothing.alias("parent"), nothing.alias("declared"),
        nothing.alias("observed"), F.lit("claims nothing").alias("problem"),
    )
    columns = ["child", "role", "parent", "declared", "observed"]
    return marked.select(*columns, problem.alias("problem")).unionByName(lone)


def _spread(start: DataFrame, links: DataFrame) -> DataFrame:
    """All names reached from ``start`` by going from parents to children."""
    front = durable(start.distinct())
    reached = [front]
    while not front.isEmpty():
        known = reduce(DataFrame.union, reached)
        step = front.withColumnRenamed("name", "parent").join(links, "parent")
        step = step.select(F.col("child").alias("name")).distinct()
        front = durable(step.join(known, "name", "left_anti"))
        reached.append(front)
    return reduce(DataFrame.union, reached).distinct()
