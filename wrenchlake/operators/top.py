"""The first rows of a frame, or of each of its groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _whole(df: DataFrame, order: list[Column]) -> list[Column]:
    """The order with all columns behind it, so that only equal rows tie."""
    return [*order, *[F.col(f"`{c}`") for c in df.columns]]


def first_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in ``order``, ties settled by all columns.

    Each task keeps its own first ``n`` and these are merged; nothing is sorted
    as a whole. ``n`` rows meet in one task, so it should be a report's length.
    """
    return df.orderBy(*_whole(df, order)).limit(n)


def first_rows_per_group(df: DataFrame, keys: list[str], n: int, order: list[Column], place: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group, with their place in it if a name for that is given.

    Spark applies the limit before the shuffle, so a hot group costs ``n`` rows
    of each task.
    """
    name = place or "_place"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_whole(df, order))))
    kept = ranked.filter(F.col(name) <= n)
    return kept if place else kept.drop(name)
