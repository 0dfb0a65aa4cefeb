"""The N best items of every group.

Each partition ranks its own rows first. A partition's N-th best score can be no
higher than the group's true N-th best, so the greatest such score over all
partitions is a bound: rows below it are dropped before the survivors of a
group meet. No more than N rows a partition and group are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(scored: DataFrame, groups: Sequence[str], item: str, score: str, n: int) -> DataFrame:
    """(groups..., item, score, rank): ranks 1..n by score, ties to the smaller item.

    Null scores rank last, after all others, and null items last of a tie; a
    null in a group column is a value of its own; repeated rows rank one after
    the other; n below 1 or an empty table gives no rows. Other columns are dropped.
    """
    keys = [f"g{i}" for i in range(len(groups))]
    rows = scored.select(*[F.col(c).alias(k) for c, k in zip(groups, keys)], F.col(item).alias("item"), F.col(score).alias("score"))
    best_first = [F.col("score").desc_nulls_last(), F.col("item").asc_nulls_last()]
    local = rows.withColumn("part", F.spark_partition_id()).withColumn("local_rank", F.row_number().over(Window.partitionBy("part", *keys).orderBy(*best_first))).filter(F.col("local_rank") <= n)
    bounds = local.filter(F.col("local_rank") == n).groupBy(*keys).agg(F.max("score").alias("bound"))
    a, b = local.alias("a"), bounds.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    survivors = a.join(b, same, "left").filter(F.col("bound").isNull() | (F.col("score") >= F.col("bound"))).select(*[f"a.{k}" for k in keys], "item", "score")
    ranked = survivors.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))).filter(F.col("rank") <= n)
    return ranked.select(*[F.col(k).alias(c) for c, k in zip(groups, keys)], F.col("item").alias(item), F.col("score").alias(score), "rank")
