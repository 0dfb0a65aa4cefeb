"""A feature table by entity and kind of event, kept up to date by signed deltas.

The state holds, for each entity and kind, the number of events, the total of a
measure and the time of the latest event. A delta row carries sign +1 (insert)
or -1 (retract). Counts and totals just add. A latest time is only in doubt
where a retracted event was as late as the latest one and no inserted event is
later; only those entities and kinds are computed again from their events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import cut_lineage

STATE = ["entity", "kind", "n", "total", "last"]


def signed(events: DataFrame, entity: str, kind: str, last: str, measure: str, sign: int = 1) -> DataFrame:
    """(entity, kind, at, amount, sign) of events; rows with a null entity are left out, a null kind is a kind of its own."""
    return events.filter(F.col(entity).isNotNull()).select(F.col(entity).alias("entity"), F.col(kind).alias("kind"), F.col(last).alias("at"), F.col(measure).alias("amount"), F.lit(sign).alias("sign"))


def build(deltas: DataFrame) -> DataFrame:
    """The state of inserts only: (entity, kind, n, total, last).

    A null amount adds 0, a null time never is the latest; last is null where
    all times are. An empty table gives an empty state.
    """
    return deltas.groupBy("entity", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("amount", F.lit(0))).alias("total"), F.max("at").alias("last"))


def of_keys(events: DataFrame, keys: DataFrame) -> DataFrame:
    """Those events (entity, kind, ...) whose entity and kind are among keys; a null kind is a kind of its own."""
    e, k = events.alias("e"), keys.select("entity", "kind").alias("k")
    return e.join(k, (F.col("e.entity") == F.col("k.entity")) & F.col("e.kind").eqNullSafe(F.col("k.kind")), "left_semi")


def apply_deltas(state: DataFrame, deltas: DataFrame, remaining: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state after signed deltas; remaining holds the events (entity, kind, at) that are left.

    remaining is read only for the entities and kinds whose latest event was
    retracted. It may be a function of those keys (entity, kind), so that
    whatever makes the events sees the keys first. Entities and kinds without any event left drop out. A retraction
    of an event that was never inserted is the caller's error and shows as a
    count below zero, which raises no error but drops the row. The new state is
    checkpointed in the shared folder.
    """
    # an event put in and taken out again at one time leaves no doubt about that time
    net = deltas.groupBy("entity", "kind", "at").agg(F.sum("sign").alias("sign"), F.sum(F.coalesce("amount", F.lit(0)) * F.col("sign")).alias("amount"))
    change = net.groupBy("entity", "kind").agg(
        F.sum("sign").alias("dn"),
        F.sum("amount").alias("dtotal"),
        F.max(F.when(F.col("sign") > 0, F.col("at"))).alias("ins"),
        F.max(F.when(F.col("sign") < 0, F.col("at"))).alias("ret"),
    )
    # union and group instead of a null-safe outer join: both sides are one row a key
    nothing = F.lit(None)
    both = state.select("entity", "kind", "n", "total", "last", F.lit(0).cast("bigint").alias("dn"), F.lit(0).cast("bigint").alias("dtotal"), nothing.cast(state.schema["last"].dataType).alias("ins"), nothing.cast(state.schema["last"].dataType).alias("ret"))
    both = both.unionByName(change.select("entity", "kind", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("total"), nothing.cast(state.schema["last"].dataType).alias("last"), "dn", "dtotal", "ins", "ret"))
    new = both.groupBy("entity", "kind").agg(
        (F.sum("n") + F.sum("dn")).alias("n"), (F.sum("total") + F.sum("dtotal")).alias("total"), F.max("last").alias("old"), F.max("ins").alias("ins"), F.max("ret").alias("ret")
    )
    new = new.filter("n > 0")
    top = F.greatest("old", "ins")  # ignores a null
    doubtful = F.coalesce(F.col("ret") >= top, F.lit(False))
    marked = new.select("entity", "kind", "n", "total", F.when(~doubtful, top).alias("last"), doubtful.alias("doubtful"))
    marked = cut_lineage(marked)
    sure = marked.filter("not doubtful").select(*STATE)
    redo = marked.filter("doubtful").select("entity", "kind", "n", "total")
    if redo.isEmpty():
        return sure
    left = remaining(redo.select("entity", "kind")) if callable(remaining) else remaining
    again = of_keys(left.select("entity", "kind", "at"), redo).groupBy("entity", "kind").agg(F.max("at").alias("last"))
    redone = redo.alias("d").join(again.alias("a"), (F.col("d.entity") == F.col("a.entity")) & F.col("d.kind").eqNullSafe(F.col("a.kind")), "left").select("d.entity", "d.kind", "n", "total", "last")
    return sure.unionByName(redone)


def by_entity(state: DataFrame) -> DataFrame:
    """One row an entity: (entity, n_kinds, n, total, last, features), features an array of structs sorted by kind.

    An entity holds at most as many entries as there are kinds of events.
    """
    return state.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_kinds"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max("last").alias("last"),
        F.array_sort(F.collect_list(F.struct("kind", "n", "total", "last"))).alias("features"),
    )


def wide(state: DataFrame, kinds: list[str]) -> DataFrame:
    """One row an entity with n_, total_ and last_ columns for each kind named.

    One aggregate collects an entity's kinds into a map, and columns are looked
    up there, so hundreds of kinds cost hundreds of projections, not aggregates.
    """
    named = state.filter("kind is not null").select("entity", "kind", F.struct("n", "total", "last").alias("v"))
    maps = named.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("kind", "v"))).alias("m"))
    every = state.select("entity").distinct().join(maps, "entity", "left")
    cols = []
    for k in kinds:
        v = F.try_element_at("m", F.lit(k))
        cols += [F.coalesce(v["n"], F.lit(0)).alias(f"n_{k}"), F.coalesce(v["total"], F.lit(0)).alias(f"total_{k}"), v["last"].alias(f"last_{k}")]
    return every.select("entity", *cols)
