"""Computing expensive columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later expressions read instead of recomputing.

    Neighbouring projections are merged by the optimizer, which copies an expression into every
    place that uses it. A one-element ``inline`` stays an operator of its own (inside the same
    code-generated stage), so a parse or a rule list is evaluated once per row. Pass structs along
    as flat columns: the optimizer's field pruning does not follow them through several steps.
    """
    kept = [name for name in df.columns if name not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
