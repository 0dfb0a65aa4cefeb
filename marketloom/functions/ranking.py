"""Ranked selections shared by the recommenders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int | None = None, rank: str = "rank") -> DataFrame:
    """Rows numbered from 1 within a group, the first k kept; Spark limits groups before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked if k is None else ranked.filter(F.col(rank) <= k)


def top(df: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of all, numbered: k rows reach the single task that numbers them."""
    return df.orderBy(*order).limit(k).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def modes(df: DataFrame, by: str, columns: dict[str, str]) -> DataFrame:
    """The most frequent non-null value of each column, the smallest on a tie: {output: column}."""
    return df.groupBy(by).agg(*[F.mode(c, deterministic=True).alias(out) for out, c in columns.items()])


def min_max(df: DataFrame, column: str, by: Sequence[str], flat: float) -> Column:
    """(x - min) / (max - min) within a group; flat where all are equal."""
    w = Window.partitionBy(*by)
    low, high = F.min(column).over(w), F.max(column).over(w)
    return F.when(high > low, (F.col(column) - low) / (high - low)).otherwise(F.lit(flat))
