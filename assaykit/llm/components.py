"""Connected components of links between ids, by the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.session import durable, few_parts, small_if, small_side


def attach(rows: DataFrame, labels: DataFrame | None, column: str) -> DataFrame:
    """Add ``component``: the label of the id in ``column``, or that id itself.

    With labels marked for broadcast the rows stay where they are.
    """
    if labels is None:
        return rows.withColumn("component", F.col(column))
    labels = labels.select(F.col("id").alias(column), F.col("component").alias("known"))
    joined = rows.join(labels, column, "left")
    return joined.withColumn("component", F.coalesce("known", column)).drop("known")


def connect(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, component) for all ids of ``links`` (a, b) and of ``labels``, the components so far.

    Links are first lifted to components. Then every node takes the smallest label around it and
    follows labels to their label, until nothing changes; the number of turns grows with the
    logarithm of the longest path. Tables of every turn are checkpointed, in few files if they are
    small, and labels are broadcast as long as they are counted to be few.
    """
    if labels is not None:
        labels = small_side(labels)
        one = attach(links, labels, "a").select(F.col("component").alias("a"), "b")
        links = attach(one, labels, "b").select("a", F.col("component").alias("b"))
    links = links.where("a <> b")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # every node is its own neighbour too
    itself = links.select(F.explode(F.array("a", "b")).alias("a")).select("a", F.col("a").alias("b"))
    nodes = 2 * links.count()  # at most
    both = durable(few_parts(both.union(itself).distinct(), 2 * nodes))
    state = both.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    state = durable(few_parts(state, nodes))
    while True:
        known = small_if(state, nodes)
        own = F.when(F.col("a") == F.col("b"), F.col("component"))
        around = both.join(known.withColumnRenamed("id", "b"), "b").groupBy("a").agg(
            F.min("component").alias("low"), F.max(own).alias("before")
        )
        jump = known.select(F.col("id").alias("low"), F.col("component").alias("next"))
        lower = around.join(jump, "low", "left")
        new = lower.select(
            F.col("a").alias("id"), F.coalesce("next", "low").alias("component"), "before"
        )
        new = durable(few_parts(new, nodes))
        changed = not new.where("component <> before").isEmpty()
        state = new.select("id", "component")
        if not changed:
            break
    if labels is None:
        return state
    # old members follow their component; nodes that were no member come as they are
    known = small_if(state, nodes)
    old = attach(labels.select("id", F.col("component").alias("c")), known, "c")
    old = old.select("id", "component")
    return durable(old.union(state.join(labels.select("id"), "id", "left_anti")))
