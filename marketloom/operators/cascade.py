"""The budgeted cascade over candidate sources, and simpler ensembles.

Sources fill each user's list in order, and what a source may add depends on
what earlier ones placed. A source offers a user a few hundred candidates at
most, so all offers of a user meet in one row, after one shuffle, and the fold
over the sources runs inside that row with array functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.ranking import best, min_max

KEY = ["user_id", "item_id"]
#: Steps of a source: how its budget, the valid filter and the items already placed come after each other.
CUT_FIRST, PLACED_FIRST, INDEXED, WHOLE, REST = "cut, valid, placed", "placed, cut, valid", "placed, cut", "placed", "rest"
OFFER = "array<struct<item_id: string, valid: boolean>>"


@dataclass(frozen=True)
class Source:
    """rows: (user_id, item_id, rank), or one row a user with a list (user_id, items), see shared_lists().

    Those of a REST source are lists (user_id, items, turn), see rest_lists().
    all_valid: nothing but valid items is offered, so they are not looked up.
    """

    name: str
    rows: DataFrame
    steps: str = CUT_FIRST
    all_valid: bool = False


def with_valid(rows: DataFrame, valid: DataFrame | None) -> DataFrame:
    """rows with a column valid: whether the item is among the valid ones."""
    if valid is None:
        return rows.withColumn("valid", F.lit(True))
    known = valid.select("item_id", F.lit(True).alias("valid")).distinct()
    return rows.join(known, "item_id", "left").fillna(False, ["valid"])


def rest_lists(users: DataFrame, lists: DataFrame, keys: Sequence[str], other: DataFrame | None = None, valid: DataFrame | None = None, turn: Column | None = None) -> DataFrame:
    """(user_id, items, turn) for a REST source: the list (item_id, rank) of a user's keys, shared by all users with the same.

    Users without a match get the short list other, (item_id, rank), started
    turn places later. Lists hold as many rows as a user can have places.
    """
    made = with_valid(lists.select(*keys, "item_id", "rank"), valid).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "item_id", "valid"))).alias("_offer"))
    named = made.select(*[F.col(c).alias(f"_key_{c}") for c in keys], "_offer")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys])
    plain = lambda c: F.transform(c, lambda x: F.struct(x["item_id"].alias("item_id"), x["valid"].alias("valid")))
    met = users.join(named, same, "left").select("user_id", plain(F.col("_offer")).alias("mine"))
    nothing = F.array().cast(OFFER)
    if other is None:
        return met.select("user_id", F.coalesce("mine", nothing).alias("items"), F.lit(0).alias("turn"))
    shown = with_valid(other.select("item_id", "rank"), valid).agg(plain(F.sort_array(F.collect_list(F.struct("rank", "item_id", "valid"))))).scalar()
    return met.select("user_id", F.coalesce("mine", shown, nothing).alias("items"), F.when(F.col("mine").isNull(), F.lit(0) if turn is None else turn).otherwise(0).alias("turn"))


def shared_lists(users: DataFrame, lists: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """(user_id, items): the first k of the valid items (item_id, rank) under a user's keys, a list being made once however many users share it."""
    short = best(lists.select(*keys, "item_id", F.col("rank").alias("r")), keys, [F.col("r"), F.col("item_id")], k)
    return rest_lists(users, short, keys).select("user_id", "items")


def offers(asked: DataFrame, sources: Sequence[Source], budgets: Mapping[str, int], k: int, valid: DataFrame | None, capped: bool = True) -> DataFrame:
    """(user_id, s0, s1, ...): what each source offers a user, in its order."""
    parts, known, lists, before = [], [], {}, 0
    for i, source in enumerate(sources):
        budget = budgets[source.name]
        # no more than the budget, or the budget beside what sources before can have placed, can be looked at
        most = {CUT_FIRST: budget, PLACED_FIRST: budget + before, INDEXED: budget + before}.get(source.steps)
        before = min(k, before + (budget if capped or source.steps != WHOLE else k))
        if "items" in source.rows.columns:
            lists[f"s{i}"] = source.rows.select("user_id", (F.col("items") if most is None else F.slice("items", 1, most)).alias(f"s{i}"))
            continue
        rows = source.rows.select(*KEY, "rank")
        rows = rows if most is None else rows.filter(F.col("rank") <= most)
        (known if source.all_valid else parts).append(rows.select(*KEY, "rank", F.lit(i).alias("at")))
    every = asked.select("user_id", F.lit(True).alias("asked"))
    for rows, of_rows in ((parts, valid), (known, None)):
        if rows:
            every = with_valid(reduce(DataFrame.unionByName, rows), of_rows).unionByName(every, allowMissingColumns=True)
    # sort_array() compares in compiled code
    of = lambda i: F.sort_array(F.collect_list(F.when(F.col("at") == i, F.struct("rank", "item_id", "valid"))))
    shown = [of(i).alias(f"s{i}") for i in range(len(sources)) if f"s{i}" not in lists]
    met = every.groupBy("user_id").agg(F.max("asked").alias("asked"), *shown).filter("asked").drop("asked")
    for name, rows in lists.items():
        met = met.join(rows, "user_id", "left").withColumn(name, F.coalesce(name, F.array().cast(OFFER)))
    return met


def fold_lists(users: DataFrame, sources: Sequence[Source], budgets: Mapping[str, int], k: int, valid: DataFrame | None = None, capped: bool = True) -> DataFrame:
    """(user_id, placed: array of (item_id, source)) of every user asked about."""
    asked = users.select("user_id").filter("user_id is not null").distinct()
    used = [s for s in sources if s.steps != REST and budgets.get(s.name, 0) > 0]
    lists = offers(asked, used, budgets, k, valid, capped)
    placed_type = "array<struct<item_id: string, source: string>>"
    lists = lists.withColumn("placed", F.array().cast(placed_type)).withColumn("taken", F.array().cast("array<string>"))

    def grown(lists: DataFrame, name: str, new: Column, most: int | None) -> DataFrame:
        left = F.lit(k) - F.size("placed")
        room = left if most is None else F.least(left, F.lit(most))
        added = F.transform(F.slice(new, F.lit(1), room), lambda x: F.struct(x.alias("item_id"), F.lit(name).alias("source")))
        # offers are not looked at where a list is full
        lists = lists.withColumn("placed", F.when(left > 0, F.concat("placed", added)).otherwise(F.col("placed")))
        return lists.withColumn("taken", F.col("placed.item_id"))

    # by hashes, in the order of the offer, an item once, no null
    fresh = lambda ids: F.array_except(ids, F.concat("taken", F.array(F.lit(None).cast("string"))))
    valid_ids = lambda offer: F.filter(offer, lambda x: x["valid"])["item_id"]
    for i, source in enumerate(used):
        budget, offer = budgets[source.name], F.col(f"s{i}")
        if source.steps == PLACED_FIRST:
            new = F.array_intersect(F.slice(fresh(offer["item_id"]), 1, budget), valid_ids(offer))
        elif source.steps == INDEXED:
            new = F.slice(fresh(offer["item_id"]), 1, budget)
        else:
            new = fresh(offer["item_id"] if source.all_valid else valid_ids(offer))
        lists = grown(lists, source.name, new, budget if capped else None).drop(f"s{i}")
    for source in sources:
        if source.steps == REST:
            lists = lists.join(source.rows.select("user_id", "items", "turn"), "user_id", "left").fillna(0, ["turn"])
            left = F.lit(k) - F.size("placed")
            cut = F.slice(F.coalesce("items", F.array().cast(OFFER)), F.lit(1), left)
            shift = F.coalesce(F.try_mod(F.col("turn"), left), F.lit(0)).cast("int")
            turned = F.concat(F.slice(cut, shift + 1, F.lit(k)), F.slice(cut, F.lit(1), shift))
            lists = grown(lists.withColumn("cut", turned), source.name, fresh(valid_ids(F.col("cut"))), None).drop("items", "turn", "cut")
    return lists.drop("taken")


def fold(users: DataFrame, sources: Sequence[Source], budgets: Mapping[str, int], k: int, valid: DataFrame | None = None, capped: bool = True) -> DataFrame:
    """(user_id, item_id, pos, source): at most k items a user, each once.

    capped cuts what a source places at its budget; without it a source may
    place everything it was asked for. Users without any candidate give no rows.
    """
    return laid_out(fold_lists(users, sources, budgets, k, valid, capped))


def laid_out(lists: DataFrame) -> DataFrame:
    return lists.select("user_id", F.posexplode("placed").alias("at", "x")).select("user_id", "x.item_id", (F.col("at") + 1).alias("pos"), "x.source")


def filled_lists(lists: DataFrame, popular: DataFrame, k: int, valid: DataFrame | None = None) -> DataFrame:
    """Lists of fold_lists() filled up to k from a short global list (item_id, rank), skipping what a user already has.

    The first 2k valid rows of popular are enough, as a user holds at most k of
    them already; they come to every task as one value.
    """
    fill = popular if valid is None else popular.join(valid.select("item_id"), "item_id", "left_semi")
    short = fill.orderBy("rank", "item_id").limit(2 * k).agg(F.array_sort(F.collect_list(F.struct("rank", "item_id")))).scalar()
    lists = lists.withColumn("fill", short)
    new = F.filter(F.coalesce("fill", F.array().cast("array<struct<rank: int, item_id: string>>")), lambda x: ~F.array_contains(F.col("placed.item_id"), x["item_id"]))
    left = F.lit(k) - F.size("placed")
    added = F.transform(F.slice(new, F.lit(1), left), lambda x: F.struct(x["item_id"].alias("item_id"), F.lit("padding").alias("source")))
    return lists.withColumn("placed", F.when(left > 0, F.concat("placed", added)).otherwise(F.col("placed"))).drop("fill")


def padded_lists(lists: DataFrame, popular: DataFrame, k: int, valid: DataFrame | None = None) -> DataFrame:
    """The same, laid out: (user_id, item_id, pos, source)."""
    return laid_out(filled_lists(lists, popular, k, valid))


def padded(placed: DataFrame, users: DataFrame, popular: DataFrame, k: int, valid: DataFrame | None = None) -> DataFrame:
    """The same for lists that are laid out: (user_id, item_id, pos, source) for every user."""
    asked = users.select("user_id").filter("user_id is not null").distinct()
    lists = placed.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("pos", "item_id", "source"))).alias("x"))
    plain = F.transform("x", lambda x: F.struct(x["item_id"].alias("item_id"), x["source"].alias("source")))
    nothing = F.array().cast("array<struct<item_id: string, source: string>>")
    return padded_lists(asked.join(lists, "user_id", "left").select("user_id", F.coalesce(plain, nothing).alias("placed")), popular, k, valid)


def tracked(placed: DataFrame, names: Sequence[str], positives: DataFrame | None = None) -> DataFrame:
    """One-hot columns is_from_<source>, and a label where positive pairs are given."""
    out = placed.withColumns({f"is_from_{n}": (F.col("source") == n).cast("int") for n in names})
    if positives is None:
        return out
    hits = positives.select(*KEY).distinct().withColumn("label", F.lit(1))
    return out.join(hits, KEY, "left").fillna(0, ["label"])


def submission(ranked: DataFrame, users: DataFrame) -> DataFrame:
    """(ID, user_id, rank, item_id): IDs count up by the users' position and the rank.

    users holds (user_id, user_pos), positions from 0 without holes; every user has
    the same number of rows, so an ID follows from position and rank alone. ranked
    are rows (user_id, item_id, pos) or lists (user_id, placed), which meet their
    user before they are laid out.
    """
    if "placed" in ranked.columns:
        width = ranked.agg(F.max(F.size("placed"))).scalar()
        rows = ranked.join(users, "user_id").select("user_id", "user_pos", F.posexplode("placed").alias("at", "x")).select("user_id", "user_pos", (F.col("at") + 1).alias("pos"), "x.item_id")
    else:
        width, rows = ranked.agg(F.max("pos")).scalar(), ranked.join(users, "user_id")
    return rows.select((F.col("user_pos") * width + F.col("pos")).cast("bigint").alias("ID"), "user_id", F.col("pos").alias("rank"), "item_id")


def first_source_wins(sources: Sequence[DataFrame], k: int) -> DataFrame:
    """(user_id, item_id, source, score, rank) from ranked sources (user_id, item_id, score, rank), scores scaled to 0..1 within a user and source."""
    every = reduce(DataFrame.unionByName, [s.select(*KEY, "score", F.col("rank").alias("r"), F.lit(i).alias("source")) for i, s in enumerate(sources)])
    scaled = every.withColumn("score", min_max(every, "score", ["user_id", "source"], 1.0))
    once = best(scaled, KEY, [F.col("source"), F.col("r")], 1, "first").drop("first")
    return best(once, ["user_id"], [F.col("source"), F.col("r"), F.col("item_id")], k).select(*KEY, "source", "score", "rank")


def weighted_blend(sources: Sequence[tuple[DataFrame, float]], k: int) -> DataFrame:
    """Sum of weighted scores scaled to 0..1 within a user and source; equal scores scale to 0, a single row keeps its score."""

    def part(df: DataFrame, weight: float) -> DataFrame:
        w = Window.partitionBy("user_id")
        low, high, n = F.min("score").over(w), F.max("score").over(w), F.count(F.lit(1)).over(w)
        span = F.when(high > low, high - low).otherwise(1.0)
        return df.select(*KEY, (F.when(n > 1, (F.col("score") - low) / span).otherwise(F.col("score")) * weight).alias("score"))

    every = reduce(DataFrame.unionByName, [part(df, w) for df, w in sources])
    return best(every.groupBy(*KEY).agg(F.sum("score").alias("score")), ["user_id"], [F.col("score").desc(), F.col("item_id")], k)


def by_segment(segments: DataFrame, lists: Mapping[str, DataFrame]) -> DataFrame:
    """Each user's list from the source named for the user's segment."""
    parts = [rows.join(segments.filter(F.col("segment") == name).select("user_id"), "user_id", "left_semi").withColumn("segment", F.lit(name)) for name, rows in lists.items()]
    return reduce(DataFrame.unionByName, parts)


def contributions(placed: DataFrame) -> DataFrame:
    """How many places each source filled, for how many users."""
    return placed.groupBy("source").agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("user_id").alias("n_users"))
