"""Table profiles: nulls, cardinality, frequent values, summaries. One pass a figure, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long(wide: DataFrame, columns: Sequence[str], *figures: str) -> DataFrame:
    """One row of figures <figure>__<column> turned into a row a column."""
    parts = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{i}").alias(f) for f in figures]) for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, share) of columns with any null."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls__{i}") for i, c in enumerate(columns)], *[F.avg(F.col(c).isNull().cast("int")).alias(f"share__{i}") for i, c in enumerate(columns)])
    return _long(wide, columns, "nulls", "share").filter("nulls > 0")


def cardinality(df: DataFrame, most: int = 200, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_distinct) of columns with few values; columns named like ids are not counted."""
    columns = [c for c in (columns or df.columns) if not (c == "id" or c.endswith("_id"))]
    # each value once a column: pairs combine before the shuffle, unlike several exact distinct counts in one row
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])).alias("r")).select("r.*").filter("v is not null").distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")).filter(F.col("n_distinct") <= most)


def value_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """(value, n): the n most frequent values, null included, ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(n)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, mean, min, max) of numeric columns."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n__{i}"), F.avg(v).alias(f"mean__{i}"), F.min(v).alias(f"min__{i}"), F.max(v).alias(f"max__{i}")]
    return _long(df.agg(*aggs), columns, "n", "mean", "min", "max")


def table_profile(df: DataFrame) -> DataFrame:
    """(column, type, nulls, n_distinct): every column with its type, nulls and, where few, its number of values."""
    spark = df.sparkSession
    types = spark.createDataFrame([(c, t) for c, t in df.dtypes], "column string, type string")
    return types.join(null_counts(df).select("column", "nulls"), "column", "left").join(cardinality(df), "column", "left").fillna(0, ["nulls"])


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(n_keys, n_orphans): distinct non-null keys and those without a row in the dimension."""
    keys = facts.select(key).filter(F.col(key).isNotNull()).distinct()
    known = dim.select(key, F.lit(1).alias("_known")).distinct()
    return keys.join(known, key, "left").agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("_known").isNull()).alias("n_orphans"))
