"""Per-key results when a few keys hold most records.

Rows are first grouped by key and value together, which spreads a hot key over
as many groups as it has values and shrinks it to one weighted row a value.
Counts, distinct counts and modes then follow from the weighted rows by
partial aggregation. Percentiles find the bin of values that holds the wanted
rank from sums by bin, and sort only inside that bin, so that no key is ever
sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compress(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): one row a distinct key and value, nulls included.

    Repeated rows count each time; an empty table gives no rows; other columns
    are never read, whatever their names.
    """
    return df.select(F.col(key).alias("key"), F.col(value).alias("value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def key_totals(weighted: DataFrame) -> DataFrame:
    """(key, n_rows, n_valued, n_distinct, mode) of weighted rows.

    n_valued and n_distinct ignore null values; the mode is the value with the
    most rows, the smaller one on a tie, null where a key has only nulls.
    """
    held = F.col("value").isNotNull()
    return weighted.groupBy("key").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(held, F.col("n")).otherwise(0)).alias("n_valued"),
        F.count("value").alias("n_distinct"),
        F.min_by("value", F.when(held, F.struct(-F.col("n"), F.col("value")))).alias("mode"),
    )


def log_bins(per_octave: int = 16) -> Callable[[Column], Column]:
    """A monotone map from numbers to at most a few thousand bins."""
    return lambda v: F.floor(F.signum(v) * F.log2(1.0 + F.abs(v.cast("double"))) * per_octave).cast("int")


def at_ranks(weighted: DataFrame, ranks: dict[str, Callable[[Column], Column]], bins: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, <name>...): the value at each rank, from 1 in order of value; a rank is a function of the key's number of rows.

    Nulls are ignored; keys with only nulls are absent. bins maps a value to
    a bin that never falls as the value grows; the default suits counts and
    durations. Values such as timestamps want linear bins.
    """
    bins = bins or log_bins()
    rows = weighted.filter("value is not null").withColumn("bin", bins(F.col("value")))
    by_key = Window.partitionBy("key")
    binned = (
        rows.groupBy("key", "bin")
        .agg(F.sum("n").alias("w"))
        .withColumn("total", F.sum("w").over(by_key))
        .withColumn("before", F.sum("w").over(by_key.orderBy("bin")) - F.col("w"))
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), rank(F.col("total")).cast("bigint").alias("rank")) for i, rank in enumerate(ranks.values())]))
    hit = binned.withColumn("want", wanted).select("key", "bin", "want.i", (F.col("want.rank") - F.col("before")).alias("rank"), "w").filter("rank > 0 and rank <= w")
    hit = hit.groupBy("key", "bin").agg(F.collect_list(F.struct("i", "rank")).alias("wants"))
    in_bin = Window.partitionBy("key", "bin").orderBy("value")
    r, h = rows.alias("r"), hit.alias("h")
    reached = r.join(h, F.col("r.key").eqNullSafe(F.col("h.key")) & (F.col("r.bin") == F.col("h.bin"))).select("r.key", "r.bin", "value", "n", "wants")
    reached = reached.withColumn("upto", F.sum("n").over(in_bin)).withColumn("want", F.explode("wants"))
    reached = reached.filter((F.col("want.rank") <= F.col("upto")) & (F.col("want.rank") > F.col("upto") - F.col("n")))
    return reached.groupBy("key").agg(*[F.max(F.when(F.col("want.i") == i, F.col("value"))).alias(name) for i, name in enumerate(ranks)])


def percentiles(weighted: DataFrame, shares: Sequence[float], bins: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, p<share in percent>...): the smallest value whose weight reaches the share. Exact; see at_ranks()."""
    return at_ranks(weighted, {f"p{round(s * 100)}": lambda total, s=s: F.greatest(F.ceil(total * F.lit(s)), F.lit(1)) for s in shares}, bins)


def medians(weighted: DataFrame, bins: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, median), the mean of the two values in the middle where their number is even."""
    middle = at_ranks(weighted, {"low": lambda total: F.floor((total + 1) / 2), "high": lambda total: F.floor(total / 2) + 1}, bins)
    return middle.select("key", ((F.col("low") + F.col("high")) / 2).alias("median"))


def heavy_keys(df: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """(key, n_rows) of keys, not null, that hold at least a share of all rows.

    All rows count, repeats and null keys too. At most 1/share keys come out.
    """
    weighted = compress(df, key, value)
    by_key = weighted.groupBy("key").agg(F.sum("n").alias("n_rows"))
    everything = df.agg(F.count(F.lit(1))).scalar()
    return by_key.filter(F.col("key").isNotNull() & (F.col("n_rows") >= everything * F.lit(share)))
