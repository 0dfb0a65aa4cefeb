"""Mixing sources to target shares along a curriculum.

Each source has a weight that changes over training time 0..1, piecewise linear
between knots and scaled so that its integral is the source's target share. A
source's records stand in a random order, one pass after another; a record's
place in that line of tokens is turned into a training position by inverting
the integral of the weight. Sorting all records by position gives the mixture.

Running totals are taken inside hash buckets of a source and pass, from sums
over the buckets before, so no source is ever summed up in one task. A source
has as many buckets as keep each at BUCKET_RECORDS records, whatever its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KNOTS = (0.0, 0.5, 1.0)
BUCKET_RECORDS = 200_000
#: Keys are the first so many hexadecimal digits of an md5.
KEY_DIGITS = 13


def integrated(schedule: Mapping[str, Sequence[float]], source: str, knots: Sequence[float]) -> list[tuple[float, float, float, float, float]]:
    """Segments (start, weight, slope, cumulative before, cumulative after) of a source, integral 1."""
    m = schedule.get(source, [1.0] * len(knots))
    if len(m) != len(knots) or min(m) < 0:
        raise ValueError(f"schedule of {source} needs {len(knots)} weights of 0 or more")
    area = sum((a + b) / 2 * (y - x) for a, b, x, y in zip(m, m[1:], knots, knots[1:]))
    if area <= 0:
        raise ValueError(f"schedule of {source} is 0 throughout")
    out, so_far = [], 0.0
    for a, b, x, y in zip(m, m[1:], knots, knots[1:]):
        a, b = a / area, b / area
        piece = (a + b) / 2 * (y - x)
        out.append((x, a, (b - a) / (y - x), so_far, so_far + piece))
        so_far += piece
    return out


def position_of(source: Column, done: Column, schedule: Mapping[str, Sequence[float]], knots: Sequence[float]) -> Column:
    """The training time at which a source has used up a share done, 0..1, of its demand."""
    default = [1.0] * len(knots)
    shape = {s: integrated(schedule, s, knots) for s in schedule}

    def invert(segments: list[tuple[float, float, float, float, float]]) -> Column:
        out = None
        for start, weight, slope, before, after in reversed(segments):
            x = F.greatest(done - F.lit(before), F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(weight * weight) + F.lit(2 * slope) * x, F.lit(0.0)))
            t = F.lit(start) + F.coalesce(F.try_divide(2 * x, F.lit(weight) + root), F.lit(0.0))
            out = t if out is None else F.when(done <= after, t).otherwise(out)
        return out

    chosen = invert(integrated({"": default}, "", knots))
    for s, segments in shape.items():
        chosen = F.when(source == s, invert(segments)).otherwise(chosen)
    return F.least(chosen, F.lit(1.0))


def plan_sources(supply: DataFrame, targets: DataFrame, total: int | None, fill: bool) -> DataFrame:
    """(source, supply, n_records, share, wanted, demand, passes) from (source, supply, n_records); one row a listed source with records, few by what targets are."""
    wanted = targets.filter("source is not null and target_share > 0 and max_repeats > 0").select(F.col("source").alias("wanted_source"), F.col("target_share").cast("double").alias("target_share"), "max_repeats")
    every = Window.partitionBy()
    known = supply.join(wanted, F.col("source") == F.col("wanted_source")).withColumn("share", F.col("target_share") / F.sum("target_share").over(every))
    known = known.withColumn("cap", F.col("supply") * F.col("max_repeats").cast("double")).withColumn("ratio", F.col("cap") / F.col("share"))
    if total is None:
        level = F.floor(F.min("ratio").over(every)).cast("double")
        size = level
    else:
        size = level = F.lit(float(total))
        if fill:
            # sources run out in the order of their ratios; the others share what those leave of the total
            before = Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
            left, shares_left = size - F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.lit(1.0) - F.coalesce(F.sum("share").over(before), F.lit(0.0))
            known = known.withColumn("fits", left / shares_left)
            level = F.coalesce(F.max(F.when(F.col("fits") <= F.col("ratio"), F.col("fits"))).over(every), F.max("ratio").over(every))
    planned = known.withColumn("wanted", F.col("share") * size).withColumn("demand", F.least(F.col("share") * level, F.col("cap")))
    return planned.select("source", "supply", "n_records", "share", "wanted", "demand", F.least(F.col("max_repeats"), F.ceil(F.col("demand") / F.col("supply"))).alias("passes"))


def supplies(records: DataFrame, source: str, size: str) -> DataFrame:
    return records.select(F.col(source).alias("source"), F.col(size).alias("size")).filter("source is not null and size > 0").groupBy("source").agg(F.sum("size").alias("supply"), F.count(F.lit(1)).alias("n_records"))


def mix(
    records: DataFrame,
    record: str,
    source: str,
    size: str,
    targets: DataFrame,
    schedule: Mapping[str, Sequence[float]] | None = None,
    knots: Sequence[float] = KNOTS,
    total: int | None = None,
    fill: bool = False,
    seed: int = 0,
    bucket_records: int = BUCKET_RECORDS,
) -> DataFrame:
    """(position, record, source, repeat, size) sorted by position.

    targets has source, target_share and max_repeats. Without total, the mixture
    is the largest at which every source with any tokens meets its share within
    max_repeats. With a larger total a source gives what its repeats allow; with
    fill the others then make up for it, in proportion to their shares, as far
    as their own repeats go. report() tells what is missing. A
    record is used at most max_repeats times, once a pass, and belongs to the
    mixture when the middle of its tokens lies within its source's demand, so a
    source misses its demand by half a record at most.
    Records with a null or unlisted source, or without tokens, are left out;
    targets with a null source, share or repeats are ignored, and shares are
    scaled to sum to 1 over the sources that have tokens. Repeated rows are
    records of their own. No records give no rows. The records are read twice,
    so what makes them should be stored first if it is dear.
    """
    rows = records.select(F.col(record).alias("record"), F.col(source).alias("source"), F.col(size).alias("size")).filter("source is not null and size > 0")
    plan = plan_sources(supplies(records, source, size), targets, total, fill).withColumn("buckets", F.ceil(F.col("n_records") / bucket_records)).drop("share", "wanted", "n_records")
    placed = rows.join(plan, "source").withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1)))
    key = F.conv(F.substring(F.md5(F.concat_ws("/", F.col("record").cast("string"), F.col("repeat").cast("string"), F.lit(str(seed)))), 1, KEY_DIGITS), 16, 10).cast("bigint")
    placed = placed.withColumn("key", key).withColumn("bucket", F.floor(F.col("key") / F.lit(float(16**KEY_DIGITS)) * F.col("buckets")))
    line = ["source", "repeat", "bucket"]
    by_line = Window.partitionBy("source", "repeat").orderBy("bucket")
    offsets = placed.groupBy(*line).agg(F.sum("size").alias("in_bucket"))
    offsets = offsets.withColumn("before", F.sum("in_bucket").over(by_line) - F.col("in_bucket")).drop("in_bucket")
    inside = Window.partitionBy(*line).orderBy("key", "record", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("upto", F.sum("size").over(inside)).join(offsets, line)
    middle = F.col("repeat") * F.col("supply") + F.col("before") + F.col("upto") - F.col("size") / 2
    chosen = summed.withColumn("middle", middle).filter(F.col("middle") <= F.col("demand"))
    at = position_of(F.col("source"), F.col("middle") / F.col("demand"), schedule or {}, knots)
    mixed = chosen.select(at.alias("position"), F.col("record").alias(record), F.col("source").alias(source), F.col("repeat").cast("bigint").alias("repeat"), F.col("size").alias(size))
    return mixed.orderBy("position", source, record, "repeat")


def shares(mixture: DataFrame, source: str, size: str, targets: DataFrame) -> DataFrame:
    """(source, target_share, size, share, n_records, most_repeats) of every target, 0 for those without records."""
    got = mixture.groupBy(F.col(source).alias("s")).agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("n_records"), (F.max("repeat") + 1).alias("most_repeats"))
    every = targets.join(got, F.col("source") == F.col("s"), "left").fillna(0, ["size", "n_records", "most_repeats"])
    return every.select("source", "target_share", "size", F.coalesce(F.try_divide(F.col("size"), F.sum("size").over(Window.partitionBy())), F.lit(0.0)).alias("share"), "n_records", "most_repeats")


def report(mixture: DataFrame, records: DataFrame, source: str, size: str, targets: DataFrame, total: int | None = None, fill: bool = False) -> DataFrame:
    """shares() with supply, wanted, and missing: how much less than its share of the total a source gives as its repeats run out."""
    plan = plan_sources(supplies(records, source, size), targets, total, fill).select(F.col("source").alias("p"), "supply", F.round("wanted").cast("bigint").alias("wanted"), F.round(F.greatest(F.col("wanted") - F.col("demand"), F.lit(0.0))).cast("bigint").alias("missing"))
    got = shares(mixture, source, size, targets)
    return got.join(plan, F.col("source") == F.col("p"), "left").drop("p").fillna(0, ["supply", "wanted", "missing"])


def records_in_order(mixture: DataFrame, records: DataFrame, record: str) -> DataFrame:
    """The records themselves, as often and in the order as the mixture has them, range-partitioned by position."""
    carried = records.drop(*[c for c in mixture.columns if c != record and c in records.columns])
    return mixture.join(carried, record).orderBy("position", record, "repeat")
