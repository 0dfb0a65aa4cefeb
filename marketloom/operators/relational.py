"""Relational building blocks with the null and tie rules that the pipelines rely on."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def where_equal(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Rows whose columns equal a value or are in a list; both reach the file scan. None matches nothing."""
    for column, value in filters.items():
        many = isinstance(value, Iterable) and not isinstance(value, str)
        df = df.filter(F.col(column).isin(list(value)) if many else F.col(column) == value)
    return df


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs on the right; null keys never match."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur on the right; rows with a null key drop out too."""
    for c in on:
        df = df.filter(F.col(c).isNotNull())
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    return df.fillna(value, [c for c, kind in df.dtypes if kind in NUMERIC])


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Rows numbered from 0 over an order of all rows.

    Rows are range-partitioned first; each partition numbers its own rows after
    the counts of those before it.
    """
    ordered = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    placed = ordered.withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(placed)  # the counts and the rows must see one partitioning
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])) - 1
    return placed.withColumn("_at", at).join(before, "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def ordinal(column: Column, order: Sequence[str]) -> Column:
    """The place of a label in a given order, for sorting by meaning instead of spelling."""
    out = F.lit(len(order))
    for i, label in reversed(list(enumerate(order))):
        out = F.when(column == label, i).otherwise(out)
    return out


def rotate(rank: Column, shift: Column, n: Column) -> Column:
    """The rank, from 1, after a list of n is started shift places later."""
    return F.pmod(rank - 1 - shift, n) + 1
