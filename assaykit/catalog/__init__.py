"""Registered queries over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaykit.catalog import corpus, evaluation, reviews, serving, splits
from assaykit.session import configure

_THEMES = (corpus, splits, evaluation, reviews, serving)
Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: _configured(query) for theme in _THEMES for name, query in theme.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for theme in _THEMES for name, sql in theme.ORACLES.items()}


def _configured(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(configure(spark), folder)

    return run
