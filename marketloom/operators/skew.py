"""Salted equi-joins for keys known to be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import cut_lineage


def hot_list(df: DataFrame, key: str, spread_by: str, share: float = 0.01) -> list:
    """The keys, not null, with at least a share of the rows: no more than 1/share values."""
    return hot_and_latest(df, key, spread_by, share)[0]


def hot_and_latest(df: DataFrame, key: str, spread_by: str, share: float = 0.01, latest: Column | None = None) -> tuple[list, object]:
    """hot_list() and the greatest of latest over all rows.

    Rows are grouped by key and spread_by first, so a hot key is as many groups
    as it has values there. One row a key is stored, so the table is read once.
    """
    at = F.lit(None).cast("bigint") if latest is None else latest
    by_both = df.groupBy(F.col(key).alias("key"), F.col(spread_by).alias("by")).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("at"))
    by_key = cut_lineage(by_both.groupBy("key").agg(F.sum("n").alias("n"), F.max("at").alias("at")))
    everything = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("at").alias("at")).first()
    hot = by_key.filter(F.col("key").isNotNull() & (F.col("n") >= F.lit(share) * everything["n"])).select("key").orderBy("key").collect()
    return [r["key"] for r in hot], everything["at"]


def salt_of(key: Column, hot: list, by: Column, salts: int) -> Column:
    """0, or for a hot key a number below salts that depends on another column."""
    if not hot:
        return F.lit(0)
    return F.when(key.isin(hot), F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0)


def all_salts(key: Column, hot: list, salts: int) -> Column:
    """Every salt that salt_of may give to the key, for explode on the other side."""
    if not hot:
        return F.array(F.lit(0))
    return F.when(key.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
