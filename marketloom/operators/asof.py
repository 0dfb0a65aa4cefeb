"""Attributes as they were known at the time of each event.

Changes become known at their load time and rank by what they describe. Time is
cut into periods. For each entity and period in which it may be asked for, the
state known at the period's start is materialised together with the changes
that became known inside the period. An event joins the one row of its entity
and period and replays only the changes up to its own time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.scalar import micros
from marketloom.operators.skew import all_salts, salt_of

WEEK = 7 * 86_400_000_000


def known_log(changes: DataFrame, entity: str, known_at: str, rank: Sequence[str], values: Sequence[str], period_us: int = WEEK) -> DataFrame:
    """(entity, period, until, state, log) from changes to an entity's attributes.

    state is the best change known before the period, by rank and then load
    time, or null; log holds the changes loaded within the period in load order.
    A row stands for the periods from period to before until, which is null
    after the entity's last change. Rows with a null entity or null load time
    are never known and left out; exact repeats count once; of changes alike in
    rank and load time the one with the larger values wins.
    """
    best = F.struct(*[F.col(c) for c in rank], F.col("_at"), *[F.col(c) for c in values])
    clean = changes.filter(F.col(entity).isNotNull() & F.col(known_at).isNotNull()).select(
        F.col(entity).alias("entity"), micros(F.col(known_at)).alias("_at"), *rank, *[c for c in values if c not in rank]
    )
    by_period = (
        clean.select("entity", F.floor(F.col("_at") / period_us).alias("period"), best.alias("change"))
        .groupBy("entity", "period")
        .agg(F.array_sort(F.collect_set("change"), lambda a, b: F.when(a["_at"] < b["_at"], -1).when(a["_at"] > b["_at"], 1).otherwise(0)).alias("log"))
        .withColumn("top", F.array_max("log"))
    )
    so_far = Window.partitionBy("entity").orderBy("period")
    kept = by_period.select(
        "entity",
        "period",
        "log",
        F.max("top").over(so_far.rowsBetween(Window.unboundedPreceding, -1)).alias("state"),
        F.max("top").over(so_far.rowsBetween(Window.unboundedPreceding, 0)).alias("after"),
        F.lead("period").over(so_far).alias("next"),
    )
    nothing = F.slice("log", 1, 0)
    with_changes = F.struct("period", (F.col("period") + 1).alias("until"), "state", "log")
    quiet = F.struct((F.col("period") + 1).alias("period"), F.col("next").alias("until"), F.col("after").alias("state"), nothing.alias("log"))
    has_quiet = F.col("next").isNull() | (F.col("next") > F.col("period") + 1)
    return kept.select("entity", F.explode(F.when(has_quiet, F.array(with_changes, quiet)).otherwise(F.array(with_changes))).alias("r")).select("entity", "r.*")


def as_known(
    events: DataFrame,
    event: str,
    entity: str,
    ts: str,
    changes: DataFrame,
    known_at: str,
    rank: Sequence[str],
    values: Sequence[str],
    period_us: int = WEEK,
    hot: Sequence[str] = (),
    salts: int = 16,
    latest: int | None = None,
) -> DataFrame:
    """(event, entity, known): each event with the struct of the best change known at its time.

    known is null where nothing was known. Each event id counts once; events
    with a null id, entity or time are left out. A change loaded at the very
    time of the event is known. Changes loaded after the last event are not
    looked at, and events after the last change share one period, so clocks that
    run far ahead on one side cost nothing. hot names entities that hold a large
    share of the events: their events are spread over salts tasks a period and
    their log rows copied to each. latest, the time of the last event in
    microseconds, saves a pass over the events.
    """
    hot = list(hot)
    asked = events.filter(F.col(event).isNotNull() & F.col(entity).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(event).alias("event"), F.col(entity).alias("entity"), micros(F.col(ts)).alias("us")
    )
    end = events.agg(F.max(micros(F.col(ts)))).scalar() if latest is None else F.lit(latest)
    changes = changes.filter(micros(F.col(known_at)) <= end)
    log = known_log(changes, entity, known_at, rank, values, period_us)
    last = F.floor(changes.agg(F.max(micros(F.col(known_at)))).scalar() / period_us)
    asked = asked.withColumn("period", F.least(F.floor(F.col("us") / period_us), last + 1)).withColumn("salt", salt_of(F.col("entity"), hot, F.col("event"), salts))
    # repeats of an event share all four keys, so one exchange serves both the distinct and the join
    asked = asked.repartition("entity", "period", "salt").distinct()
    log = log.select("entity", F.explode(F.sequence("period", F.coalesce(F.col("until") - 1, last + 1))).alias("period"), "state", "log")
    log = log.select("*", F.explode(all_salts(F.col("entity"), hot, salts)).alias("salt"))
    replay = F.aggregate("log", F.col("state"), lambda best, c: F.when((c["_at"] <= F.col("us")) & (best.isNull() | (c > best)), c).otherwise(best))
    return asked.join(log, ["entity", "period", "salt"], "left").select("event", "entity", "us", replay.alias("known"))
